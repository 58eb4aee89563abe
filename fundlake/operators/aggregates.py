"""Global statistics attached as scalars (A1, A2, A10, A11, J6, D15),
group enrichment (A4 + J5) and keyed lookups (J1, J2, J4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import (exact_round, exact_sum, q, safe_div, sql_round, sql_sum,
                                        to_col)
from fundlake.session import fresh_dir


def global_stats(df: DataFrame, exprs: Sequence[Column]) -> DataFrame:
    """One-row aggregate (always exactly one row, NULL/0 on empty input).

    Replaces driver-side ``collect()[0][0]`` scalars: the row never leaves
    the cluster, and one scan computes every statistic of the bundle.
    """
    return df.agg(*exprs)


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row DataFrame to every row.

    A scalar subquery: it is computed once, nothing is joined, and more than
    one row is an error at run time (no row gives NULLs).
    """
    row = one_row.select(F.struct(*[F.col(q(c)) for c in one_row.columns]).alias("_row")).scalar()
    # one reference to the subquery, however many columns it has
    return df.withColumn("_row", row).select(*[F.col(q(c)) for c in df.columns], F.inline(F.array("_row")))


def weighted_mean(value, weight, null_weights: str = "keep", scale: int | None = 2) -> Column:
    """``sum(w * x) / sum(w)`` as an aggregate Column.

    ``null_weights="keep"``: a NULL value drops out of the numerator only and
    its weight stays in the denominator (the dashboards' definition);
    ``"drop"``: its weight is excluded too.
    """
    if null_weights not in ("keep", "drop"):
        raise ValueError("null_weights must be 'keep' or 'drop'")
    if isinstance(value, str) and isinstance(weight, str):
        x, w = q(value), q(weight)
        den = sql_sum(w) if null_weights == "keep" else sql_sum(
            f"CASE WHEN {x} IS NOT NULL THEN {w} END")
        m = f"try_divide({sql_sum(f'{w} * {x}')}, {den})"
        return F.expr(sql_round(m, scale) if scale is not None else m)
    x, w = to_col(value), to_col(weight)
    den = exact_sum(w) if null_weights == "keep" else exact_sum(F.when(x.isNotNull(), w))
    m = safe_div(exact_sum(w * x), den)
    return exact_round(m, scale) if scale is not None else m


def group_enrich(df: DataFrame, key: str | Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Attach per-group aggregates to every row of the group (left join).

    The aggregate is written to the shared folder first, so that its size is
    known when the join is planned: under the broadcast threshold ``df`` is
    not shuffled at all (a few hot groups would otherwise meet in as many
    tasks); above it, the sort-merge join splits skewed keys.  Rows with a
    NULL key get NULL aggregates.
    """
    keys = [key] if isinstance(key, str) else list(key)
    path = fresh_dir(df.sparkSession, "group")
    df.groupBy(*keys).agg(*aggs).write.parquet(path)
    return df.join(df.sparkSession.read.parquet(path), keys, "left")


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str] | dict[str, str],
           how: str = "left") -> DataFrame:
    """Equi-join on key columns; ``{left_col: right_col}`` drops the right key."""
    if isinstance(keys, dict):
        cond = [left[lk] == right[rk] for lk, rk in keys.items()]
        joined = left.join(right, cond, how)
        for rk in keys.values():
            joined = joined.drop(right[rk])
        return joined
    return left.join(right, list(keys), how)

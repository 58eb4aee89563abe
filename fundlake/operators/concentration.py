"""Portfolio weights (D11), HHI contribution (D12) and HHI (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import q, sql_round, sql_sum
from fundlake.operators.aggregates import attach_scalar


def _weight_sql(measure: str, scale: int | None) -> str:
    w = f"try_divide({q(measure)}, `_total`) * 100.0D"
    return sql_round(w, scale) if scale is not None else w


def weights(df: DataFrame, measure: str, out: str = "weight_pct", scale: int | None = 2) -> DataFrame:
    """``out = round(measure / total(measure) * 100, scale)``; the total is a
    one-row aggregate attached by broadcast (NULL weights when it is 0)."""
    tot = df.agg(F.expr(f"{sql_sum(q(measure))} AS `_total`"))
    return attach_scalar(df, tot).withColumn(out, F.expr(_weight_sql(measure, scale))).drop("_total")


def _contribution_sql(weight: str) -> str:
    return f"pow({q(weight)} / 100.0D, 2) * 10000.0D"


def concentration(df: DataFrame, measure: str, out: str, weight: str = "weight_pct",
                  contribution: str = "hhi_contribution", exact: bool = False,
                  scale: int = 2) -> DataFrame:
    """Weights, per-row HHI contribution and the HHI attached to every row.

    Default order of rounding: weight to 2 dp -> contribution
    ``(weight/100)^2 * 10000`` to 2 dp -> HHI = round(sum, 0).  ``exact=True``
    computes the contribution and HHI from unrounded weights instead.
    """
    df = weights(df, measure, weight, None if exact else scale)
    contrib = _contribution_sql(weight)
    df = df.withColumn(contribution, F.expr(contrib if exact else sql_round(contrib, scale)))
    hhi_ = df.agg(F.expr(f"{sql_round(sql_sum(q(contribution)), 0)} AS {q(out)}"))
    df = attach_scalar(df, hhi_)
    if exact:
        df = df.withColumns({weight: F.expr(sql_round(q(weight), scale)),
                             contribution: F.expr(sql_round(q(contribution), scale))})
    return df


def hhi(df: DataFrame, measure: str, out: str = "hhi") -> DataFrame:
    """One-row HHI of ``measure`` (same rounding order as :func:`concentration`)."""
    tot = df.agg(F.expr(f"{sql_sum(q(measure))} AS `_total`"))
    w = sql_round(f"try_divide({q(measure)}, `_total`) * 100.0D", 2)
    c = sql_round(f"pow({w} / 100.0D, 2) * 10000.0D", 2)
    return attach_scalar(df.select(measure), tot).agg(
        F.expr(f"{sql_round(sql_sum(c), 0)} AS {q(out)}"))

"""Time-series operators: growth (W1, W2; window lag or skew-safe
distributed lag), running totals (W3, H1), row numbering (D14), latest row
per key (W4, F1, F3) and CAGR (A7-A9; grouped, or as window aggregates on an
existing key partitioning).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import q, sql_exact, sql_inexact, sql_round, to_col
from fundlake.session import checkpoint_dir


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def distributed_lag(df: DataFrame, key, order, cols: Sequence[str],
                    tiebreak: Sequence[str] = (), prefix: str = "_prev_",
                    partitions: int | None = None) -> DataFrame:
    """``lag(c)`` per key in (order, tiebreak) order, without any task holding a
    whole key: exact even when one key holds a third of all rows.

    Rows are range-partitioned on (key, order, tiebreak) and checkpointed
    (stable partition ids).  Inside a partition the lag is a window over
    (partition, key).  The first row of a key inside a partition takes the
    last row of the nearest preceding partition, when that row has the same
    key: one boundary row per partition, broadcast (size bound: the
    partition count).  Adds ``<prefix><col>`` columns.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys, ords = _names(key), [*_names(order), *tiebreak]
    allk = [*keys, *ords]
    ranged = (df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in allk])
                .withColumn("_part", F.expr("spark_partition_id()"))
                .checkpoint(eager=True))
    struct_k = ", ".join(q(k) for k in keys)
    struct_all = ", ".join(q(k) for k in allk)
    last = ranged.groupBy("_part").agg(F.expr(
        f"max_by(struct(struct({struct_k}) AS k, {', '.join(q(c) for c in cols)}), "
        f"struct({struct_all})) AS _last"))
    prev_part = last.selectExpr(
        "_part", "lag(_last) OVER (ORDER BY _part) AS _bnd")
    order_sql = ", ".join(f"{q(k)} ASC NULLS FIRST" for k in ords)
    w = f"OVER (PARTITION BY _part, {struct_k} ORDER BY {order_sql})"
    out = ranged.join(F.broadcast(prev_part), "_part").withColumns(
        {"_first": F.expr(f"row_number() {w} = 1"),
         **{f"_in_{c}": F.expr(f"lag({q(c)}) {w}") for c in cols}})
    same = f"(_bnd IS NOT NULL AND _bnd.k <=> struct({struct_k}))"
    out = out.withColumns({f"{prefix}{c}": F.expr(
        f"CASE WHEN _first THEN IF({same}, _bnd.{q(c)}, NULL) ELSE `_in_{c}` END")
        for c in cols})
    return out.drop("_part", "_bnd", "_first", *[f"_in_{c}" for c in cols])


def growth(df: DataFrame, key, order, cols: Sequence[str], tiebreak: Sequence[str] = (),
           suffix: str = "_yoy_pct", out: Sequence[str] | None = None,
           scale: int = 2, skew_safe: bool = False) -> DataFrame:
    """Change against the previous row of the same key, in percent.

    ``(x - lag(x)) / abs(lag(x)) * 100``, rounded; previous *row*, not
    previous period.  All columns share one window spec, so Catalyst plans a
    single Window node (one shuffle by key, one sort).  For a per-period
    series (one row per key and period) the group size is bounded by the
    calendar; for raw input where one key may hold a large share of the rows,
    ``skew_safe=True`` uses :func:`distributed_lag` instead.
    """
    spec = (f"PARTITION BY {', '.join(q(k) for k in _names(key))} "
            f"ORDER BY {', '.join(q(k) for k in [*_names(order), *tiebreak])}")
    outs = list(out) if out else [f"{c.removesuffix('_m')}{suffix}" for c in cols]
    # One lag per column (a window function is not de-duplicated when the
    # derived expression repeats it), then the ratio in a Project above.
    prevs = {f"_prev_{o}": F.expr(f"lag({q(c)}) OVER ({spec})") for c, o in zip(cols, outs)}
    if skew_safe:
        df = distributed_lag(df, key, order, list(cols), tiebreak, prefix="_lagtmp_")
        df = df.withColumns({p: F.col(f"_lagtmp_{c}") for p, c in zip(prevs, cols)}).drop(
            *[f"_lagtmp_{c}" for c in cols])
    else:
        df = df.withColumns(prevs)
    df = df.withColumns({o: F.expr(sql_round(
        f"try_divide({q(c)} - {q('_prev_' + o)}, abs({q('_prev_' + o)})) * 100.0D", scale))
        for c, o in zip(cols, outs)})
    return df.drop(*prevs)


# Sampled keys per bucket from which the bounds are taken.
_SAMPLED = 24


def range_buckets(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """``df`` with ``_part``: a row's bucket, 0 to n-1, in ascending order of ``keys`` (NULLs first).

    A pure function of the row and of up to n - 1 bounds.  The bounds are
    quantiles of the keys with the smallest hashes, ``24 * n`` of them at most,
    and enter as a scalar subquery; nothing runs while the plan is built.
    Buckets are balanced if the keys are (nearly) unique, whatever values they
    take.
    """
    names = ", ".join(q(k) for k in keys)
    sample = (df.select(F.expr(f"struct({names})").alias("k"), F.expr(f"xxhash64({names})").alias("h"))
                .orderBy("h").limit(_SAMPLED * n))
    bounds = sample.agg(F.sort_array(F.collect_list("k")).alias("s")).select(F.expr(
        f"filter(transform(sequence(1, {max(n - 1, 1)}), i -> get(s, cast(i * size(s) div {n} as int))), "
        "x -> x IS NOT NULL)").alias("bounds")).scalar()
    steps = ", ".join(str(1 << i) for i in range(n.bit_length(), -1, -1))
    # binary search: how many bounds are not above the row's keys
    part = F.expr(f"aggregate(array({steps}), 0, (low, step) -> IF(low + step <= size(_bounds) "
                  f"AND get(_bounds, low + step - 1) <= struct({names}), low + step, low))")
    return df.withColumn("_bounds", bounds).withColumn("_part", part).drop("_bounds")


def _prefix(df: DataFrame, keys: Sequence[str], values: dict[str, str],
            partitions: int | None, group: Sequence[str] = ()) -> DataFrame:
    """Prefix sums of ``values`` (SQL expressions of a decimal or other numeric type) in ``keys`` order,
    starting anew for every value of ``group``.

    One shuffle of the rows, no single-partition window over them, no files:

    1. every row gets a range bucket of the total order ``keys`` (balanced
       even when one order value is hot, because ``keys`` ends in a unique
       tie-break);
    2. per-bucket totals from a narrow scan, combined map-side -> at most
       ``partitions`` rows (and one more per group) -> running sum over them
       (the only single-partition step, bounded by that), broadcast
       without groups and joined with them;
    3. the rows are dealt out by bucket, one task each, and a running sum
       inside each bucket is added to the offset.
    Returns ``df`` plus ``_cum_<name>`` columns.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["_part", *group]
    placed = range_buckets(df, [*group, *keys], n).withColumns({f"_v_{k}": F.expr(v) for k, v in values.items()})
    totals = (placed.groupBy(*by).agg(*[F.expr(e) for k in values for e in (
                    f"try_sum(`_v_{k}`) AS `_t_{k}`", f"count(`_v_{k}`) AS `_n_{k}`")]))
    partition = ", ".join(q(c) for c in group)
    before = f"OVER ({f'PARTITION BY {partition} ' if group else ''}ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = totals.selectExpr(*[f"{q(c)} AS `_by_{c}`" for c in by], *[e for k in values for e in (
        f"sum(`_t_{k}`) {before} AS `_o_{k}`",
        f"coalesce(sum(`_n_{k}`) {before}, 0) AS `_on_{k}`")])
    order_sql = ", ".join(f"{q(k)} ASC NULLS FIRST" for k in keys)
    inside = (f"OVER (PARTITION BY {', '.join(q(c) for c in by)} ORDER BY {order_sql} "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    dealt = placed.repartitionById(n, F.col("_part"))
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    # without groups the offsets are one row per bucket; their number with groups is not bounded by it
    out = dealt.join(offsets if group else F.broadcast(offsets), same).withColumns({
        f"_cum_{k}": F.expr(f"CASE WHEN `_on_{k}` = 0 THEN sum(`_v_{k}`) {inside} "
                            f"WHEN count(`_v_{k}`) {inside} = 0 THEN `_o_{k}` "
                            f"ELSE `_o_{k}` + sum(`_v_{k}`) {inside} END")
        for k in values})
    return out.drop("_part", *[f"_by_{c}" for c in by], *[c for k in values for c in (f"_v_{k}", f"_o_{k}", f"_on_{k}")])


def running_total(df: DataFrame, order, cols: Sequence[str], tiebreak: Sequence[str] = (),
                  prefix: str = "cum_", out: Sequence[str] | None = None, scale: int = 2,
                  partitions: int | None = None, group: Sequence[str] = ()) -> DataFrame:
    """Cumulative sums of ``cols`` over the whole table (or each ``group`` of it), ordered by
    ``order`` + ``tiebreak`` (rows unbounded preceding .. current row).

    NULL order keys sort first; NULL values are skipped (the result stays
    NULL until the first non-null value).  Sums are exact and rounded once.
    ``order`` + ``tiebreak`` should be unique for a deterministic result.
    """
    keys = _names(order) + list(tiebreak)
    outs = list(out) if out else [f"{prefix}{c}" for c in cols]
    # what does not fit the decimal is summed apart, and only what does not fit
    values = {f"{o}{kind}": e for c, o in zip(cols, outs) for kind, e in (
        ("", f"CASE WHEN NOT {sql_inexact(q(c))} THEN {sql_exact(q(c))} END"),
        ("_rest", f"CASE WHEN {sql_inexact(q(c))} THEN CAST({q(c)} AS DOUBLE) END"))}
    res = _prefix(df, keys, values, partitions, group)
    return res.selectExpr(*[q(c) for c in df.columns], *[
        f"CASE WHEN `_cum_{o}_rest` IS NULL THEN CAST(round(`_cum_{o}`, {scale}) AS DOUBLE) ELSE "
        f"round(coalesce(CAST(`_cum_{o}` AS DOUBLE), 0D) + `_cum_{o}_rest`, {scale}) END AS {q(o)}"
        for o in outs])


def number_rows(df: DataFrame, order, out: str = "row_num", tiebreak: Sequence[str] = (),
                partitions: int | None = None) -> DataFrame:
    """1-based position in ``order`` + ``tiebreak`` (distributed, like
    :func:`running_total` of 1 per row)."""
    keys = _names(order) + list(tiebreak)
    res = _prefix(df, keys, {out: "1L"}, partitions)
    return res.selectExpr(*[q(c) for c in df.columns], f"CAST(`_cum_{out}` AS BIGINT) AS {q(out)}")


def latest_per_key(df: DataFrame, key, order, cols: Sequence[str] | None = None,
                   tiebreak: Sequence[Column | str] = (), where: Column | str | None = None,
                   rename: dict[str, str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest (order, tiebreak...).

    A grouped ``max_by`` over a struct: partial aggregation on the map side,
    so a key holding a third of all rows never reaches one task whole.
    Ties beyond ``tiebreak`` are broken by the remaining selected columns,
    so the result is deterministic.
    """
    keys = _names(key)
    if where is not None:
        df = df.where(where)
    cols = [c for c in (cols or df.columns) if c not in keys]
    tb = [t if isinstance(t, str) else None for t in tiebreak]
    if all(t is not None for t in tb):
        rank_sql = ", ".join(q(c) for c in [*_names(order), *tb, *cols])
        latest = F.expr(f"max_by(struct({', '.join(q(c) for c in cols)}), struct({rank_sql}))")
    else:
        rank = F.struct(*[to_col(c) for c in _names(order)], *[to_col(t) for t in tiebreak],
                        *[F.col(c) for c in cols])
        latest = F.max_by(F.struct(*cols), rank)
    res = df.groupBy(*keys).agg(latest.alias("_latest"))
    rename = rename or {}
    return res.selectExpr(*[q(k) for k in keys],
                          *[f"_latest.{q(c)} AS {q(rename.get(c, c))}" for c in cols])


def cagr(df: DataFrame, key, time: str, value: str, where: Column | str | None = None,
         out: str = "revenue_cagr_pct", scale: int = 2, keep_parts: bool = False) -> DataFrame:
    """Compound annual growth per key, one grouped aggregate (no self-join).

    first/last value = value at the min/max ``time`` among non-null values
    (ties: smallest value first); the span uses min/max ``time`` over all
    rows, NULL values included.  NULL unless first > 0 and span > 0; NaN
    (negative last value) is kept.
    """
    keys = _names(key)
    if where is not None:
        df = df.where(where)
    v, t = q(value), q(time)
    rank = f"CASE WHEN {v} IS NOT NULL THEN struct({t}, {v}) END"
    g = df.groupBy(*keys).agg(
        F.expr(f"min({t}) AS first_year"), F.expr(f"max({t}) AS last_year"),
        F.expr(f"min_by({v}, {rank}) AS first_value"),
        F.expr(f"max_by({v}, {rank}) AS last_value"))
    span = "(last_year - first_year)"
    growth_ = (f"(pow(last_value / first_value, 1.0D / CAST({span} AS DOUBLE)) - 1) * 100")
    g = g.withColumn(out, F.expr(
        f"CASE WHEN first_value > 0 AND {span} > 0 THEN {sql_round(growth_, scale)} END"))
    return g if keep_parts else g.select(*keys, out)


def with_cagr(df: DataFrame, key, time: str, value: str, where: str | None = None,
              out: str = "revenue_cagr_pct", scale: int = 2) -> DataFrame:
    """Attach :func:`cagr` to every row of its key as window aggregates.

    Same result as ``df.join(cagr(df, ...), key, "left")``, but computed over
    a ``PARTITION BY key`` window: when the input is already partitioned by
    the key (e.g. after a per-key growth window) there is no second scan of
    the input, no extra shuffle and no join.  ``where`` is SQL text selecting
    the rows that count (e.g. ``"NOT is_estimate"``).
    """
    keys = _names(key)
    cond = f"({where})" if where else "TRUE"
    v, t = q(value), q(time)
    spec = f"OVER (PARTITION BY {', '.join(q(k) for k in keys)})"
    rank = f"CASE WHEN {cond} AND {v} IS NOT NULL THEN struct({t}, {v}) END"
    parts = {"_c_fy": f"min(CASE WHEN {cond} THEN {t} END) {spec}",
             "_c_ly": f"max(CASE WHEN {cond} THEN {t} END) {spec}",
             "_c_fv": f"min_by({v}, {rank}) {spec}",
             "_c_lv": f"max_by({v}, {rank}) {spec}"}
    df = df.withColumns({k: F.expr(e) for k, e in parts.items()})
    growth_ = "(pow(_c_lv / _c_fv, 1.0D / CAST(_c_ly - _c_fy AS DOUBLE)) - 1) * 100"
    df = df.withColumn(out, F.expr(
        f"CASE WHEN _c_fv > 0 AND _c_ly - _c_fy > 0 THEN {sql_round(growth_, scale)} END"))
    return df.drop(*parts)

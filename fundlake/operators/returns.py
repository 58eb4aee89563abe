"""Return multiples (X1) and IRR (X2): advertised by the dashboards'
documentation but only supplied as inputs there; recomputed here."""

from __future__ import annotations

import sys
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import exact_round, exact_sum, safe_div, to_col

# Fund multiples as numerator columns over called capital.
FUND_MULTIPLES = {"tvpi": "total_value", "dpi": "distributions", "rvpi": "nav",
                  "moic": "total_value"}


def multiples_check(fm: DataFrame, called: str = "called_capital",
                    multiples: Mapping[str, str] = FUND_MULTIPLES, scale: int = 2) -> DataFrame:
    """One row per multiple: supplied value, value recomputed from capital
    columns, and their difference (all rounded)."""
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("supplied"),
                     exact_round(safe_div(F.col(num), F.col(called)), scale).alias("recomputed"))
            for m, num in multiples.items()]
    out = fm.select(F.explode(F.array(*rows)).alias("_m")).select("_m.*")
    return out.withColumn("difference", exact_round(F.col("supplied") - F.col("recomputed"), scale))


def dated_flows(df: DataFrame, key: str, date, amount) -> DataFrame:
    """Net flow per (key, date): the pre-aggregation that bounds IRR groups
    by the number of calendar dates, however many rows a key has.  Flows
    without a date cannot be discounted and are left out; a caller that must
    account for them counts rows with a NULL date."""
    d = F.to_date(to_col(date))
    return (df.where(d.isNotNull())
              .groupBy(F.col(key).alias("key"), d.alias("flow_date"))
              .agg(exact_sum(amount).alias("amount"))
              .where(F.col("amount").isNotNull()))


# Grid over x = log(1 + rate), finer places inside a cell, bisection steps.
_GRID = np.linspace(-20.0, 20.0, 401)
_FINER = 64
_BISECT_STEPS = 80


def _npv_sign(x_row: np.ndarray, t: np.ndarray, cf: np.ndarray, g: np.ndarray, n: int,
              tmax_row: np.ndarray) -> np.ndarray:
    """Per-group NPV rescaled by exp(x * c) with c = 0 (x >= 0) or c = t_max (x < 0).

    Same sign as the NPV, but every discount factor is <= 1, so no overflow
    for extreme rates or long horizons.
    """
    shift = np.where(x_row < 0, tmax_row, 0.0)
    return np.bincount(g, weights=cf * np.exp(-x_row * (t - shift)), minlength=n)


def solve_irr(t: np.ndarray, cf: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    """Annual rates r with sum(cf * (1+r)^-t) = 0 for ``n`` groups at once.

    ``g`` is the group index of every flow, ``t`` its time in years from the
    group's first flow; flows are in time order within a group.  A grid over
    x = log(1+r) finds the sign changes; the one nearest r = 0 is bisected to
    machine precision.  Without one on the grid, the cells around the value
    nearest zero are searched more finely, and a group whose first and last
    flows differ in sign has its root bracketed outward (the first flow
    decides the sign for large rates, the last one for rates near -100 %).
    NaN where a group's flows have one sign or no sign change is found; a
    rate beyond the double range is infinite.
    """
    tmax = np.zeros(n)
    np.maximum.at(tmax, g, t)

    def signs(x: np.ndarray) -> np.ndarray:
        return np.sign(_npv_sign(x[g], t, cf, g, n, tmax[g]))

    has_pos = np.bincount(g, weights=(cf > 0).astype(float), minlength=n) > 0
    has_neg = np.bincount(g, weights=(cf < 0).astype(float), minlength=n) > 0
    mixed = has_pos & has_neg
    vals = np.stack([_npv_sign(np.full(t.shape, x), t, cf, g, n, tmax[g]) for x in _GRID])
    sgn = np.sign(vals)
    change = (sgn[:-1] * sgn[1:]) <= 0
    dist = np.where(change, np.abs(0.5 * (_GRID[:-1] + _GRID[1:]))[:, None], np.inf)
    idx = np.argmin(dist, axis=0)
    cols = np.arange(n)
    found = np.isfinite(dist[idx, cols]) & mixed
    lo, hi, slo = _GRID[idx].copy(), _GRID[idx + 1].copy(), sgn[idx, cols]

    nonzero = np.flatnonzero(cf != 0)
    first, last = np.zeros(n), np.zeros(n)
    last[g[nonzero]] = np.sign(cf[nonzero])            # the latest one stays
    first[g[nonzero[::-1]]] = np.sign(cf[nonzero[::-1]])
    outward = mixed & ~found & (first != last)
    above = outward & (sgn[-1] != first)
    for side, end in ((above, 20.0), (outward & ~above, -20.0)):
        near, far, goal = np.full(n, end), np.full(n, 2 * end), (first if end > 0 else last)
        for _ in range(40):
            short = side & (signs(far) != goal)
            if not short.any():
                break
            near, far = np.where(short, far, near), np.where(short, 2 * far, far)
        lo, hi = np.where(side, np.minimum(near, far), lo), np.where(side, np.maximum(near, far), hi)
        slo = np.where(side, signs(lo), slo)
    found |= outward

    open_ = mixed & ~found
    if open_.any():
        k = np.argmin(np.abs(vals), axis=0)
        a, b = _GRID[np.maximum(k - 1, 0)], _GRID[np.minimum(k + 1, len(_GRID) - 1)]
        before, s_before = a, signs(a)
        for step in range(1, _FINER + 1):
            here = a + (b - a) * step / _FINER
            s_here = signs(here)
            hit = open_ & ~found & (s_before * s_here <= 0)
            lo, hi, slo = np.where(hit, before, lo), np.where(hit, here, hi), np.where(hit, s_before, slo)
            found |= hit
            before, s_before = here, s_here
    for _ in range(_BISECT_STEPS):
        mid = 0.5 * (lo + hi)
        sm = signs(mid)
        keep_lo = (sm == slo) & (sm != 0)
        lo, hi = np.where(keep_lo, mid, lo), np.where(keep_lo, hi, mid)
    with np.errstate(over="ignore"):
        return np.where(found, np.expm1(0.5 * (lo + hi)), np.nan)


def _irr_frame(pdf: pd.DataFrame) -> pd.DataFrame:
    """IRR for every key of a frame whose keys are contiguous."""
    keys, nulls = pdf["key"].to_numpy(), pdf["no_key"].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])])
    n = len(starts)
    g = np.repeat(np.arange(n), np.diff(np.r_[starts, len(keys)]))
    days = pd.to_datetime(pdf["flow_date"]).to_numpy().astype("datetime64[D]").astype(np.int64)
    first = np.minimum.reduceat(days, starts)
    last = np.maximum.reduceat(days, starts)
    rate = solve_irr((days - first[g]) / 365.0, pdf["amount"].to_numpy(dtype=float), g, n)
    return pd.DataFrame({"key": keys[starts], "no_key": nulls[starts], "irr_pct": rate * 100.0,
                         "n_flows": np.diff(np.r_[starts, len(keys)]),
                         "first_date": first.astype("datetime64[D]"),
                         "last_date": last.astype("datetime64[D]")})


def whole_keys(batches, solve):
    """Arrow batches of one partition, sorted by key: ``solve`` whole keys per
    batch; the last key of a batch is carried into the next one."""
    carry = None
    for pdf in batches:
        if carry is not None:
            pdf = pd.concat([carry, pdf], ignore_index=True)
        if pdf.empty:
            continue
        tail = ((pdf["key"] == pdf["key"].iloc[-1]) & (pdf["no_key"] == pdf["no_key"].iloc[-1])).to_numpy()
        carry = pdf[tail]
        if (~tail).any():
            yield solve(pdf[~tail].reset_index(drop=True))
    if carry is not None and len(carry):
        yield solve(carry.reset_index(drop=True))


def _irr_partition(batches):
    return whole_keys(batches, _irr_frame)


def netted(flows: DataFrame, key: str, date, amount, partitions: int | None = None) -> tuple[DataFrame, str]:
    """(net flows dealt by key and sorted by (no_key, key, flow_date), the key's type)."""
    net = dated_flows(flows, key, date, amount)
    n = partitions or int(flows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key_type = net.schema["key"].dataType.simpleString()
    # pandas has no NULL for integers: a stand-in and a flag keep every digit of the others
    stand_in = F.lit("1970-01-01" if key_type in ("date", "timestamp") else "0").cast(key_type)
    net = net.withColumn("no_key", F.col("key").isNull()).withColumn("key", F.coalesce("key", stand_in))
    return net.repartition(n, "key").sortWithinPartitions("no_key", "key", "flow_date"), key_type


def irr(flows: DataFrame, key: str, date, amount, out_key: str | None = None,
        scale: int | None = 2, partitions: int | None = None) -> DataFrame:
    """Per-key IRR (percent, annualised on actual days / 365; ``scale=None``: unrounded).

    Flows are netted per (key, date) with map-side partial aggregation, so a
    key holding a third of all rows arrives as at most one row per calendar
    date.  The netted table is hash-partitioned by key and sorted; each
    partition streams through one vectorised pandas solver in Arrow batches.
    Flows without a key are one group, with a NULL key.
    """
    # Ship the solver by value: executors need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    net, key_type = netted(flows, key, date, amount, partitions)
    schema = (f"key {key_type}, no_key boolean, irr_pct double, n_flows long, first_date date, "
              "last_date date")
    res = net.mapInPandas(_irr_partition, schema=schema)
    rate = F.col("irr_pct") if scale is None else exact_round("irr_pct", scale)
    return res.select(F.when(~F.col("no_key"), F.col("key")).alias(out_key or key),
                      F.when(~F.isnan("irr_pct"), rate).alias("irr_pct"),
                      "n_flows", "first_date", "last_date")


def irr_check(flows: DataFrame, key: str, date, amount, out_key: str | None = None,
              partitions: int | None = None) -> DataFrame:
    """Every key whose first and last net flows differ in sign (it must have a rate),
    with ``solved``: the net present value changes sign at the rate found.

    A rate that rounds to -100 % (six places) or exceeds the double range counts as solved.
    """
    net = dated_flows(flows, key, date, amount)
    rates = irr(flows, key, date, amount, out_key="_key", scale=None, partitions=partitions)
    live = net.where("amount <> 0").groupBy("key").agg(
        F.min_by("amount", "flow_date").alias("_a"), F.max_by("amount", "flow_date").alias("_z"))
    must = live.where("signum(_a) <> signum(_z)").select(F.col("key").alias("_live"))
    base = rates.join(must, F.col("_key").eqNullSafe(F.col("_live")))
    x = base.withColumn("_x", F.log1p(F.col("irr_pct") / 100.0))
    j = net.join(x, F.col("key").eqNullSafe(F.col("_key")))
    years, span = "datediff(flow_date, first_date) / 365.0D", "datediff(last_date, first_date) / 365.0D"

    def value(shift: str) -> str:
        return f"sum(amount * exp(-(_x {shift}) * ({years} - IF(_x < 0, {span}, 0D))))"

    return j.groupBy("_key", "n_flows", "first_date", "last_date", "irr_pct").agg(
        F.expr(value("- 1e-6D")).alias("_low"), F.expr(value("+ 1e-6D")).alias("_high")).select(
        F.col("_key").alias(out_key or key), "n_flows", "first_date", "last_date",
        F.coalesce((F.signum("_low") * F.signum("_high") <= 0) | (F.round("irr_pct", 6) <= -100)
                   | (F.col("irr_pct") == float("inf")), F.lit(False)).alias("solved"))

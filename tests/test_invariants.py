"""Invariants on derived Gold tables (sf0.01), plus the IRR root check."""

import numpy as np
from pyspark.sql import functions as F

from fundlake.operators.returns import _npv_sign
from fundlake.plans import queries, star

from conftest import SF001, SF01


def test_weights_sum_to_100_and_hhi_range(spark):
    rows = queries.sector_allocation(spark, SF01).collect()
    assert abs(sum(r["weight_pct"] for r in rows) - 100) < 0.05
    assert 0 < rows[0]["hhi_sector"] <= 10000


def test_last_cumulative_is_grand_total(spark):
    cf = queries.running_cashflows(spark, SF01).collect()
    last = max(cf, key=lambda r: r["row_num"])
    assert last["cum_net_cashflow_m"] == round(sum(r["net_cashflow_m"] for r in cf), 2)


def test_band_counts_cover_every_company(spark):
    n = star.holdings(spark, SF01).count()
    assert sum(r["company_count"] for r in queries.leverage_bands(spark, SF01).collect()) == n
    assert sum(r["company_count"] for r in queries.moic_bands(spark, SF01).collect()) == n


def test_latest_is_at_most_one_row_per_company(spark):
    df = queries.latest_financials(spark, SF01)
    assert df.groupBy("company_id").count().where(F.col("count") > 1).count() == 0


def test_irr_brackets_a_root(spark):
    rows = queries.irr_by_company(spark, SF001).collect()
    orders = star.table(spark, SF001, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("d"),
        F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice"))
         .otherwise(F.col("o_totalprice")).alias("a")).toPandas()
    rate = {r["company_id"]: r["irr_pct"] for r in rows}
    checked = 0
    for k, grp in orders.groupby("o_custkey"):
        r = rate.get(k)
        net = grp.groupby("d")["a"].sum().sort_index()
        t = np.array([(d - net.index[0]).days / 365.0 for d in net.index])
        cf = net.to_numpy()
        g = np.zeros(len(t), dtype=int)
        if r is None:
            xs = np.linspace(-20, 20, 4001)
            s = np.array([np.sign(_npv_sign(np.full(len(t), x), t, cf, g, 1,
                                            np.full(len(t), t.max()))[0]) for x in xs])
            assert not np.any(s[:-1] * s[1:] < 0) or not ((cf > 0).any() and (cf < 0).any())
            continue
        if r <= -99.99:  # rounds to -100 %: the root lies below log(1e-4)
            lo_x, hi_x = -20.0, float(np.log(1e-4))
        else:
            # the rate is rounded to 0.01 %: bracket +-0.6 bp in rate space
            lo_x = float(np.log1p(max(r / 100.0 - 6e-5, -1 + 1e-12)))
            hi_x = float(np.log1p(r / 100.0 + 6e-5))
        lo, hi = (np.sign(_npv_sign(np.full(len(t), v), t, cf, g, 1, np.full(len(t), t.max()))[0])
                  for v in (lo_x, hi_x))
        assert lo * hi <= 0, (k, r)
        checked += 1
    assert checked > 10

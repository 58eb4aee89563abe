"""Plan-shape checks: the scale properties the design relies on."""

from fundlake.operators import latest_per_key, running_total
from fundlake.plans import queries, star

from conftest import SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_total_moves_the_rows_once(spark):
    """One exchange of full rows (by range bucket), no checkpoint, no single-partition window over rows."""
    ev = star.flows_fine(spark, SF01)
    df = running_total(ev, "ts", ["value"], tiebreak=["event_id"])
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0].split("Subqueries")[0]
    lines = plan.splitlines()
    assert plan.count("shufflepartitionidpassthrough") == 1 and "ExistingRDD" not in plan
    # what else is exchanged are sums per bucket, and partial aggregates of bounds and counts
    for i, ln in enumerate(lines):
        if "hashpartitioning" in ln or "SinglePartition" in ln:
            assert any("Aggregate(" in below for below in lines[i + 1:i + 3]), lines[i:i + 3]


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([(1, 2020, 1.0)], "k long, y int, v double")
    plan = _plan(latest_per_key(df, "k", "y", cols=["y", "v"]))
    assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    assert "Window" not in plan


def test_filters_and_projection_reach_the_scan(spark):
    df = queries.leverage_bands(spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double," in plan


def test_risk_summary_has_no_driver_scalars(spark):
    df = queries.risk_summary(spark, SF01)
    plan = _plan(df)
    assert "LocalTableScan" not in plan and "Subquery" in plan and "NestedLoop" not in plan


def test_one_scan_per_aggregate_bundle(spark):
    """The leverage statistics and the weighted returns are each one pass over
    the holdings: orders scanned once, no driver round trip per statistic."""
    import re
    for name in ("leverage_stats", "weighted_returns", "fund_ratios"):
        df = getattr(queries, name)(spark, SF01)
        df.collect()
        plan = _plan(df).split("== Initial Plan ==")[0]
        assert len(re.findall(r"/orders\.parquet\]", plan)) == 1, name


def test_shared_holdings_are_computed_once_in_risk_summary(spark):
    df = queries.risk_summary(spark, SF01)
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0]
    assert "orders.parquet" not in plan   # branches read the materialized holdings


def test_cagr_shares_the_company_partitioning(spark):
    """The CAGR is window aggregates on the YoY window's partitioning,
    so orders are scanned only for the two feeds (not a third time)."""
    import re
    df = queries.company_financials(spark, SF01)
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"/orders\.parquet\]", plan)) == 2
    assert len(re.findall(r"/lineitem\.parquet\]", plan)) == 1


def test_stage_aggregates_are_broadcast_without_shuffling_the_deals(spark):
    """The aggregate's size is known when the join is planned."""
    from fundlake.plans import gold, silver
    plan = _plan(gold.pipeline(silver.deal_pipeline(star.deals(spark, SF01))))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_point_lookup_cuts_lineitem_before_any_shuffle(spark):
    df = queries.company_financials_by_id(spark, SF01)
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    at = next(i for i, ln in enumerate(lines) if "/lineitem.parquet]" in ln)
    above = "".join(lines[:at])
    assert above.rfind("LeftSemi") > above.rfind("hashpartitioning(l_orderkey")


def test_attached_scalars_must_be_one_row(spark):
    import pytest
    from fundlake.operators import attach_scalar
    df = spark.range(3)
    assert attach_scalar(df, spark.sql("SELECT 1 AS a, 2 AS b")).columns == ["id", "a", "b"]
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        attach_scalar(df, spark.range(2).withColumnRenamed("id", "a")).collect()


def test_entities_landed_together_share_what_they_are_made_of(spark):
    """Holdings and quarters are computed once: the entities made of them read no table again."""
    stored, each = star.bronze_entities(spark, SF01, stored=True), star.bronze_entities(spark, SF01)
    for name in ("portfolio-companies", "sector-breakdown", "geo-breakdown", "cashflows", "fund-history"):
        assert ".parquet]" not in _plan(stored[name]), name
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, each[name].collect())), name

"""Incremental ingest: only new load dates are rebuilt; results equal batch."""

from fundlake.plans import silver, star
from fundlake.session import fresh_dir
from fundlake.sources import read_table, write_bronze
from fundlake.streaming import ingest

from conftest import SF001


def test_incremental_ingest_picks_up_new_dates_only(spark):
    lake = fresh_dir(spark, "t-stream")
    bronze, silver_root, ckpt = f"{lake}/bronze", f"{lake}/silver", f"{lake}/_ckpt"
    h = star.holdings(spark, SF001)
    rev, eb = star.revenue(spark, SF001), star.ebitda(spark, SF001, with_name=True)
    write_bronze(h, bronze, "portfolio-companies", "2002-01-01")
    write_bronze(rev, bronze, "company-revenue", "2002-01-01")
    write_bronze(eb, bronze, "company-ebitda", "2002-01-01")
    tables = ["portfolio_companies", "company_financials"]
    first = ingest(spark, bronze, silver_root, ckpt, tables, as_of_year=2002)
    assert first == {"portfolio_companies": 1, "company_financials": 1}
    again = ingest(spark, bronze, silver_root, ckpt, tables, as_of_year=2002)
    assert again == {"portfolio_companies": 0, "company_financials": 0}
    write_bronze(h, bronze, "portfolio-companies", "2002-02-01")
    third = ingest(spark, bronze, silver_root, ckpt, ["portfolio_companies"], as_of_year=2002)
    assert third == {"portfolio_companies": 1}
    pc = read_table(spark, silver_root, "portfolio_companies")
    assert pc.where("load_date = '2002-02-01'").count() == 150 and pc.count() == 300
    direct = silver.portfolio_companies(h, 2002)
    got = pc.where("load_date = '2002-01-01'").drop("load_date")
    assert sorted(map(tuple, got.select(*direct.columns).collect())) == \
        sorted(map(tuple, direct.collect()))
    fin = read_table(spark, silver_root, "company_financials").drop("load_date")
    exp = silver.company_financials(rev, eb)
    assert sorted(map(tuple, fin.select(*exp.columns).collect())) == \
        sorted(map(tuple, exp.collect()))


def test_incremental_ingest_of_windowed_and_single_row_tables(spark):
    lake = fresh_dir(spark, "t-stream2")
    bronze, silver_root, ckpt = f"{lake}/bronze", f"{lake}/silver", f"{lake}/_ckpt"
    cf, fm = star.cashflows(spark, SF001), star.fund_metrics(spark, SF001)
    write_bronze(cf, bronze, "cashflows", "2002-01-01")
    write_bronze(fm, bronze, "fund-metrics", "2002-01-01")
    got = ingest(spark, bronze, silver_root, ckpt, ["quarterly_cashflows", "fund_metrics"])
    assert got == {"quarterly_cashflows": 1, "fund_metrics": 1}
    out = read_table(spark, silver_root, "quarterly_cashflows").drop("load_date")
    exp = silver.quarterly_cashflows(cf)
    assert sorted(map(tuple, out.select(*exp.columns).collect())) == \
        sorted(map(tuple, exp.collect()))
    assert read_table(spark, silver_root, "fund_metrics").first()["deployed_pct"] is not None


def test_several_new_dates_in_one_run(spark):
    lake = fresh_dir(spark, "t-stream3")
    bronze, silver_root, ckpt = f"{lake}/bronze", f"{lake}/silver", f"{lake}/_ckpt"
    h = star.holdings(spark, SF001)
    for d in ("2002-03-01", "2002-04-01", "2002-05-01"):
        write_bronze(h, bronze, "portfolio-companies", d)
    got = ingest(spark, bronze, silver_root, ckpt, ["portfolio_companies"], as_of_year=2002)
    assert got == {"portfolio_companies": 3}
    pc = read_table(spark, silver_root, "portfolio_companies")
    assert sorted(str(r[0]) for r in pc.select("load_date").distinct().collect()) == \
        ["2002-03-01", "2002-04-01", "2002-05-01"]
    assert pc.count() == 450


def test_a_late_feed_is_joined_in_and_gold_equals_batch(spark):
    from fundlake.plans import etl
    from fundlake.sources import write_bronze_all
    lake = fresh_dir(spark, "t-late")
    bronze, silver_root, ckpt = f"{lake}/bronze", f"{lake}/silver", f"{lake}/_ckpt"
    entities = star.bronze_entities(spark, SF001)
    late = entities.pop("company-ebitda")
    write_bronze_all(entities, bronze, "2002-01-01")
    ingest(spark, bronze, silver_root, ckpt, as_of_year=2002)
    fin = read_table(spark, silver_root, "company_financials")
    rows = fin.count()
    assert rows and fin.where("ebitda_m IS NOT NULL").count() == 0
    write_bronze(late, bronze, "company-ebitda", "2002-01-01")
    assert ingest(spark, bronze, silver_root, ckpt, as_of_year=2002)["company_financials"] == 1
    fin = read_table(spark, silver_root, "company_financials")
    assert fin.count() == rows and fin.where("ebitda_m IS NOT NULL").count() > 0
    etl.run_silver(spark, bronze, f"{lake}/batch", "2002-01-01", 2002)
    etl.run_gold(spark, f"{lake}/batch", f"{lake}/gold-batch")
    etl.run_gold(spark, silver_root, f"{lake}/gold-stream", load_date="2002-01-01")
    for name in ("fund_kpis", "risk_summary", "company_financials"):
        a, b = (read_table(spark, f"{lake}/{g}", name) for g in ("gold-batch", "gold-stream"))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect())), name

"""Co-partitioned Silver: joins, aggregates and windows by company without an exchange."""

import pytest
from pyspark.sql import functions as F

from fundlake.plans import etl, gold, queries, silver, star
from fundlake.session import fresh_dir
from fundlake.sources import LayerRun, create_layers, current, publish, read_layer, vacuum, write_bronze_all

from conftest import SF001


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def lake(spark):
    root = fresh_dir(spark, "t-buckets")
    write_bronze_all(star.bronze_entities(spark, SF001), f"{root}/bronze", "2002-01-01")
    etl.run_silver(spark, f"{root}/bronze", f"{root}/silver", "2002-01-01", 2002, register=True, buckets=6)
    return root


def test_gold_over_silver_has_no_exchange_by_company(spark, lake, no_broadcast):
    by_path = read_layer(spark, f"{lake}/silver", ["portfolio_companies", "company_financials"])
    by_name = {t: spark.table(f"silver.{t}") for t in by_path}
    for sv in (by_path, by_name):
        g6 = gold.portfolio_table(sv["portfolio_companies"], sv["company_financials"])
        g7 = gold.company_financials(sv["company_financials"])
        assert "SortMergeJoin" in _plan(g6) and "Window" in _plan(g7)
        assert "Exchange" not in _plan(g6) and "Exchange" not in _plan(g7)


def test_a_lookup_reads_one_bucket(spark, lake):
    fin = read_layer(spark, f"{lake}/silver", ["company_financials"])["company_financials"]
    key = int(fin.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY company_id)")).first()[0])
    one = fin.where(F.col("company_id") == key)
    assert len(one.collect()) > 0
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    bucket = fin.where(F.pmod(F.hash("company_id"), F.lit(6)) == F.expr(f"pmod(hash({key}L), 6)"))
    assert scan.metrics().apply("numOutputRows").value() == bucket.count() < fin.count()


def test_feeds_are_shuffled_once_by_company(spark, no_broadcast):
    """J1, W1 and W2 share one partitioning of each feed."""
    rev = spark.range(60).selectExpr("id % 7 AS company_id", "CAST(2000 + id AS INT) AS year", "'x' AS company_name",
                                     "1.0D AS revenue_m", "false AS is_estimate")
    eb = rev.selectExpr("company_id", "year", "company_name", "2.0D AS ebitda_m", "is_estimate")
    plan = _plan(gold.company_financials(silver.company_financials(rev, eb)))
    assert plan.count("hashpartitioning(") == 2 and "SortMergeJoin" in plan and "NestedLoop" not in plan


def test_join_of_unreadable_flags_and_missing_keys(spark):
    rev = spark.createDataFrame([(1, 2001, "a", 1.0, None), (1, 2001, "a", 2.0, True), (1, None, "a", 3.0, True),
                                 (None, 2001, "n", 4.0, True)], "company_id long, year int, company_name string, revenue_m double, is_estimate boolean")
    eb = spark.createDataFrame([(1, 2001, "a", 10.0, None), (1, 2001, "a", 20.0, False), (1, None, "a", 30.0, True),
                                (None, 2001, "n", 40.0, True)], "company_id long, year int, company_name string, ebitda_m double, is_estimate boolean")
    got = {r["revenue_m"]: r["ebitda_m"] for r in silver.company_financials(rev, eb).collect()}
    assert got == {1.0: 10.0, 2.0: None, 3.0: None, 4.0: None}


def test_null_keys_empty_tables_and_odd_names(spark):
    root = fresh_dir(spark, "t-buckets-null")
    rows = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (3, 3)], "`a key` long, `x``y` int")
    run = LayerRun(spark, root)
    assert run.write(rows, "rows", bucket_by=["a key"], buckets=3) == 4
    assert run.write(rows.limit(0), "none", bucket_by=["a key"], buckets=3) == 0
    run.commit()
    got = read_layer(spark, root, ["rows", "none"])
    assert sorted(map(tuple, got["rows"].collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert got["none"].columns == rows.columns and got["none"].count() == 0


def test_versions_keep_their_layout(spark):
    """Published, kept, switched back and vacuumed tables in buckets."""
    root = fresh_dir(spark, "t-buckets-run")
    create_layers(spark, root, ["bucketdb"])
    for n in (5, 9):
        run = LayerRun(spark, f"{root}/layer")
        run.write(spark.range(n), "a", bucket_by=["id"], buckets=2)
        run.commit()
        publish(spark, "bucketdb", current(spark, f"{root}/layer"))
        assert spark.table("bucketdb.a").count() == n
    run = LayerRun(spark, f"{root}/layer")
    run.keep("a")
    run.write(spark.range(1), "b")
    now = run.commit()
    assert now.read(spark, "a").count() == 9 and now.layouts["a"].count == 2
    assert len(vacuum(spark, f"{root}/layer", keep=1, older_than_hours=0)) == 1
    assert spark.sql("SHOW TABLES IN fundlake_buckets").where(F.col("tableName") == f"a_{now.paths['a'].split('/')[1]}").count() == 1
    assert spark.sql("DESCRIBE TABLE EXTENDED bucketdb.a").where("col_name = 'Num Buckets'").first()["data_type"] == "2"


def test_queries_over_buckets_equal_the_plain_ones(spark):
    for name in ("portfolio_copartitioned", "financials_copartitioned"):
        plain = queries.QUERIES[{"portfolio_copartitioned": "portfolio_table", "financials_copartitioned": "company_financials"}[name]]
        a, b = queries.QUERIES[name](spark, SF001), plain(spark, SF001)
        assert a.exceptAll(b.select(*a.columns)).isEmpty() and a.count() == b.count()

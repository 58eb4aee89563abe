"""Many load dates in one plan, and only what the ledger does not know."""

import re

from pyspark.sql import functions as F

from fundlake.operators import running_total
from fundlake.plans import backfill, silver, star
from fundlake.session import fresh_dir
from fundlake.sources import read_bronze, write_bronze
from fundlake.sources.bronze import CSV_OPTIONS, LOAD_DATE

from conftest import SF001


def _land_many(spark, root, entity, df, dates):
    """The rows under every one of ``dates``, a number of them changed per date, in one write."""
    many = df.crossJoin(F.broadcast(spark.createDataFrame([(d, i) for i, d in enumerate(dates)], f"{LOAD_DATE} string, _i int")))
    for c, t in df.dtypes:
        if t == "double":
            many = many.withColumn(c, F.col(c) + F.col("_i"))
    (many.drop("_i").repartition(4, LOAD_DATE).write.mode("append").options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"})
         .option("emptyValue", "").partitionBy(LOAD_DATE).csv(f"{root}/{entity}"))


def _nodes(df) -> int:
    return len(re.findall(r"\n", df._jdf.queryExecution().analyzed().toString()))


def test_two_hundred_dates_in_one_plan(spark):
    lake = fresh_dir(spark, "t-backfill")
    dates = [str(d[0]) for d in spark.sql("SELECT explode(sequence(DATE'2026-01-01', DATE'2026-07-19')) AS d").collect()]
    assert len(dates) == 200
    rev, eb, cf = star.revenue(spark, SF001), star.ebitda(spark, SF001, with_name=True), star.cashflows(spark, SF001)
    few = rev.where("company_id < 8"), eb.where("company_id < 8")
    for entity, df in (("company-revenue", few[0]), ("company-ebitda", few[1]), ("cashflows", cf)):
        _land_many(spark, f"{lake}/bronze", entity, df.limit(400), dates)
    tables = ["company_financials", "quarterly_cashflows"]
    got = backfill.backfill(spark, f"{lake}/bronze", f"{lake}/silver", tables)
    assert got == {t: dates for t in tables}
    for t in tables:
        sizes = {_nodes(backfill.dated_table(spark, f"{lake}/bronze", t, d)) for d in (dates[:2], dates[:50], dates)}
        assert len(sizes) == 1, sizes
    # a date of the backfill equals the date built alone
    for d in (dates[0], dates[117]):
        alone = {"company_financials": silver.company_financials(*[read_bronze(spark, f"{lake}/bronze", e, d) for e in ("company-revenue", "company-ebitda")]),
                 "quarterly_cashflows": silver.quarterly_cashflows(read_bronze(spark, f"{lake}/bronze", "cashflows", d))}
        for t, want in alone.items():
            there = spark.read.parquet(f"{lake}/silver/{t}").where(F.col(LOAD_DATE) == d).select(*want.columns)
            assert sorted(map(str, there.collect())) == sorted(map(str, want.collect())), (t, d)
    assert backfill.backfill(spark, f"{lake}/bronze", f"{lake}/silver", tables) == {t: [] for t in tables}


def test_only_dates_with_events_are_rebuilt(spark):
    lake = fresh_dir(spark, "t-backfill2")
    geo = spark.createDataFrame([("a", "1.5", "2"), ("b", "2.5", "3")], "region string, fmv_m string, company_count string")
    for d in ("2026-01-01", "2026-02-01"):
        write_bronze(geo, f"{lake}/bronze", "geo-breakdown", d)

    def run():
        return backfill.backfill(spark, f"{lake}/bronze", f"{lake}/silver", ["geo_breakdown"])["geo_breakdown"]

    def there():
        return {(str(r[LOAD_DATE]), r["region"], r["company_count"]) for r in spark.read.parquet(f"{lake}/silver/geo_breakdown").collect()}

    assert run() == ["2026-01-01", "2026-02-01"] and run() == []
    # another column order, a missing column, and a late drop
    write_bronze(geo.select("company_count", "region").limit(1), f"{lake}/bronze", "geo-breakdown", "2026-02-01")
    write_bronze(geo, f"{lake}/bronze", "geo-breakdown", "2025-12-01")
    assert run() == ["2025-12-01", "2026-02-01"]
    want = {(d, r, n) for d in ("2025-12-01", "2026-01-01") for r, n in (("a", 2), ("b", 3))}
    assert there() == want | {("2026-02-01", "a", 2)}
    # a deleted drop takes its partition along
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{lake}/bronze/geo-breakdown/{LOAD_DATE}=2026-02-01")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    assert run() == ["2026-02-01"] and there() == want


def test_failed_run_is_repeated(spark, monkeypatch):
    import pytest
    lake = fresh_dir(spark, "t-backfill3")
    geo = spark.createDataFrame([("a", "1.5", "2")], "region string, fmv_m string, company_count string")
    write_bronze(geo, f"{lake}/bronze", "geo-breakdown", "2026-01-01")
    monkeypatch.setattr(backfill, "record", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        backfill.backfill(spark, f"{lake}/bronze", f"{lake}/silver", ["geo_breakdown"])
    monkeypatch.undo()
    assert backfill.backfill(spark, f"{lake}/bronze", f"{lake}/silver", ["geo_breakdown"]) == {"geo_breakdown": ["2026-01-01"]}
    assert spark.read.parquet(f"{lake}/silver/geo_breakdown").count() == 1


def test_running_totals_of_groups(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 7 < 5 THEN 'big' ELSE 'small' END AS g", "CAST(id % 13 AS DOUBLE) / 4 AS v")
    got = {r.id: r.cum_v for r in running_total(df, "id", ["v"], group=["g"], partitions=7).collect()}
    sums = {}
    for r in df.orderBy("id").collect():
        sums[r.g] = sums.get(r.g, 0) + r.v
        assert got[r.id] == round(sums[r.g] + 1e-9, 2), r

"""Rules of rows, keys, references and counts; whole rows in quarantine; a failed count leaves Silver as it was."""

import pytest
from pyspark.sql import functions as F

from fundlake.operators import validation as v
from fundlake.plans import checks, etl, star
from fundlake.session import fresh_dir
from fundlake.sources import read_table, write_bronze_all

from conftest import SF001

ROWS = [(1, "a", 5.0, "x1"), (2, "b", -1.0, "x2"), (2, "b", 7.0, "y"), (None, "c", None, None), (None, "c", 101.0, "x"), (9, "it's", 100.0, "x9")]


def _table(spark):
    return spark.createDataFrame(ROWS, "id long, kind string, pct double, `_rule2` string")


def _rules(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "key long")
    return [v.in_range("pct", 0.0, 100.0), v.present("id"), v.unique(["id", "kind"]), v.refers(["id"], parent, ["key"]),
            v.one_of("kind", ["a", "b", "it's"]), v.matches("_rule2", "^x[0-9]"), v.row_change(10, 0.5, 1.0, "count_low"), v.row_change(None)]


def test_rules_mark_rows_and_are_counted(spark):
    got = v.validate(_table(spark), _rules(spark))
    assert sorted((tuple(r) for r in got.good.collect()), key=str) == [ROWS[0]] and got.good.columns == _table(spark).columns
    failed = sorted((tuple(r) for r in got.quarantined.select("id", "pct", v.FAILED).collect()), key=str)
    assert failed == sorted([
        (2, -1.0, ["pct_in_range", "id_kind_unique"]), (2, 7.0, ["id_kind_unique", "_rule2_matches"]), (None, None, ["id_present", "kind_listed"]),
        (None, 101.0, ["pct_in_range", "id_present", "kind_listed", "_rule2_matches"]), (9, 100.0, ["id_known"])], key=str)
    assert {r["rule"]: (r["checked_rows"], r["failed_rows"], r["passed"]) for r in got.report.collect()} == {
        "pct_in_range": (6, 2, False), "id_present": (6, 2, False), "id_kind_unique": (6, 2, False), "id_known": (6, 1, False),
        "kind_listed": (6, 2, False), "_rule2_matches": (6, 2, False), "count_low": (6, 0, True), "row_change": (6, 0, True)}


def test_empty_tables_no_rules_and_wrong_rules(spark):
    empty = v.validate(_table(spark).limit(0), _rules(spark))
    assert empty.good.count() == empty.quarantined.count() == 0
    assert {r["rule"] for r in empty.report.where("NOT passed").collect()} == {"count_low"}
    none = v.validate(_table(spark), [])
    assert none.good.count() == 6 and none.report.count() == 0
    with pytest.raises(ValueError):
        v.flagged(_table(spark), [v.present("id"), v.present("id")])
    with pytest.raises(ValueError):
        v.flagged(_table(spark).withColumn(v.FAILED, F.lit(1)), [])


def test_a_hot_repeated_key_stays_whole(spark):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS at")
    got = v.validate(df, [v.unique(["k"])])
    assert got.quarantined.count() == 1000 and got.good.count() == 2000


def test_run_silver_quarantines_rows_and_refuses_a_shrunk_table(spark):
    root = fresh_dir(spark, "t-rules")
    entities = star.bronze_entities(spark, SF001)
    pc = entities["portfolio-companies"]
    entities["portfolio-companies"] = pc.withColumn("ownership_pct", F.expr("IF(id % 10 = 3, 250.0D, ownership_pct)"))
    write_bronze_all(entities, f"{root}/bronze", "2002-01-01")
    counts = etl.run_silver(spark, f"{root}/bronze", f"{root}/silver", "2002-01-01", star.STAR_AS_OF_YEAR, rules=checks.silver_rules)
    n, bad = pc.count(), pc.where("id % 10 = 3").count()
    assert (counts["portfolio_companies"], counts["quarantined:portfolio_companies"]) == (n - bad, bad)
    quarantined = read_table(spark, f"{root}/silver/_quarantine", "portfolio_companies")
    assert {(r["id"] % 10, *r[v.FAILED]) for r in quarantined.select("id", v.FAILED).collect()} == {(3, "ownership_pct_in_range")}
    assert counts["quarantined:company_financials"] == 0 and read_table(spark, f"{root}/silver", "portfolio_companies").count() == n - bad
    entities["portfolio-companies"] = pc.where("id <= 3")
    write_bronze_all(entities, f"{root}/bronze", "2002-02-01")
    with pytest.raises(etl.RejectedTable, match="portfolio_companies"):
        etl.run_silver(spark, f"{root}/bronze", f"{root}/silver", "2002-02-01", star.STAR_AS_OF_YEAR, rules=checks.silver_rules)
    assert read_table(spark, f"{root}/silver", "portfolio_companies").count() == n - bad

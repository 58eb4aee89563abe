"""Stored states: merged statistics equal those over all rows; parts are replaced, forgotten, compacted."""

import pytest
from pyspark.sql import functions as F

from fundlake.operators import global_stats, weighted_mean
from fundlake.operators.mergeable import Grouping, PartialStats, count, highest, lowest, mean, total, weighted
from fundlake.functions.numeric import sql_avg, sql_sum
from fundlake.session import fresh_dir
from fundlake.sources import versions

STATS = (total("s", "x"), mean("m", "x", 6), weighted("wk", "x", "w", scale=6), weighted("wd", "x", "w", "drop", 6),
         count("n"), count("n_big", "x > 50"), highest("hi", "x"), lowest("lo", "x"))


def _store(spark, **more):
    return PartialStats(fresh_dir(spark, "t-states"), ("day",), {"all": Grouping(STATS), "k": Grouping((total("s", "x"), count("n")), ("k",)), **more})


def _rows(spark, n=900):
    # day 3 is NULL, some x and w are NULL
    return spark.range(n).selectExpr(
        "IF(id % 7 = 3, NULL, concat('d', id % 7)) AS day", "IF(id % 5 = 0, NULL, concat('k', id % 4)) AS k",
        "IF(id % 11 = 0, NULL, CAST(id AS DOUBLE) / 8 + 0.1) AS x", "IF(id % 13 = 0, NULL, CAST(id % 17 AS DOUBLE)) AS w", "id AS run", "id AS p0")


def _whole(rows):
    return global_stats(rows, [
        F.expr(f"{sql_sum('x')} AS s"), F.expr(f"round({sql_avg('x')}, 6) AS m"), weighted_mean("x", "w", scale=6).alias("wk"),
        weighted_mean("x", "w", "drop", 6).alias("wd"), F.count("*").alias("n"), F.expr("count_if(x > 50) AS n_big"),
        F.max("x").alias("hi"), F.min("x").alias("lo")]).collect()


def _by(rows):
    return sorted(map(tuple, rows.groupBy("k").agg(F.expr(f"{sql_sum('x')} AS s"), F.count("*").alias("n")).collect()), key=str)


def test_states_of_increments_equal_one_scan(spark):
    rows, store = _rows(spark), _store(spark)
    with pytest.raises(LookupError):
        store.result(spark, "all")
    assert store.update(rows.where("day IN ('d0', 'd1') OR day IS NULL")) == {"parts": 3, "replaced": 0}
    assert store.update(rows.where("day NOT IN ('d0', 'd1')")) == {"parts": 4, "replaced": 0}
    assert store.result(spark, "all").collect() == _whole(rows)
    assert sorted(map(tuple, store.result(spark, "k").collect()), key=str) == _by(rows)
    some = "day >= 'd4'"
    assert store.result(spark, "all", some).collect() == _whole(rows.where(some))
    # the plan reads states only
    assert "Range" not in store.result(spark, "all")._jdf.queryExecution().executedPlan().toString()


def test_a_part_delivered_again_replaces_its_state(spark):
    rows, store = _rows(spark), _store(spark)
    store.update(rows.withColumn("x", F.expr("IF(day IS NULL OR day = 'd2', x * 3 + 1, x)")))
    assert store.update(rows.where("day IS NULL OR day = 'd2'")) == {"parts": 2, "replaced": 2}
    assert store.result(spark, "all").collect() == _whole(rows)
    assert store.forget(spark, "day = 'd5'") == 1 and store.forget(spark, "day = 'none'") == 0
    left = rows.where("day IS NULL OR day <> 'd5'")
    assert store.result(spark, "all").collect() == _whole(left)
    store.compact(spark)
    assert store.result(spark, "all").collect() == _whole(left) and len(versions(spark, store.root)) == 5
    assert sorted(map(tuple, store.result(spark, "k").collect()), key=str) == _by(left)
    store.update(rows.where("day = 'd5'"))
    assert store.result(spark, "all").collect() == _whole(rows)


def test_no_rows(spark):
    store = _store(spark)
    assert store.update(_rows(spark).limit(0)) == {"parts": 0, "replaced": 0}
    assert [tuple(r) for r in store.result(spark, "all").collect()] == [(None, None, None, None, 0, 0, None, None)]
    assert store.result(spark, "k").count() == 0


def test_values_beyond_the_exact_type(spark):
    rows = spark.createDataFrame([("a", "k", 1e30, 1.0), ("a", "k", 2.5, 1.0), ("b", "k", -1e30, 1.0), ("c", "k", 4.0, None)],
                                 "day string, k string, x double, w double")
    store = _store(spark)
    for day in "abc":
        store.update(rows.where(F.col("day") == day))
    assert store.result(spark, "all", "day = 'c'").first()["s"] == 4.0
    assert store.result(spark, "all", "day <> 'b'").first()["s"] == pytest.approx(1e30)
    # each value fits, their sum does not
    big = spark.createDataFrame([("a", 9e25)] * 3 + [("b", 9e25)], "day string, x double")
    sums = PartialStats(fresh_dir(spark, "t-big"), ("day",), {"all": Grouping((total("s", "x"),))})
    sums.update(big)
    assert sums.result(spark, "all").first()["s"] == pytest.approx(3.6e26)

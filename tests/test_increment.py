"""Stored running totals: increments equal one full run, old rows stay unread."""

import pytest
from pyspark.sql import functions as F

from fundlake.operators import running_total
from fundlake.operators.increment import RunningTotals
from fundlake.plans import star
from fundlake.session import fresh_dir
from fundlake.sources import snapshot

from conftest import SF001


def _events(spark):
    return star.flows_fine(spark, SF001).where("ts IS NOT NULL").withColumn("ts", F.col("ts").cast("string"))


def _sorted(df):
    return sorted((tuple(r) for r in df.select("event_id", "ts", "value", "cum_value").collect()), key=str)


def _want(df):
    return _sorted(running_total(df, "ts", ["value"], tiebreak=["event_id"]))


def test_two_increments_equal_one_run_and_read_no_old_rows(spark, monkeypatch):
    ev = _events(spark)
    cut = ev.selectExpr("CAST(percentile_approx(unix_timestamp(CAST(ts AS TIMESTAMP)), 0.6) AS BIGINT) AS c").first()["c"]
    early = ev.where(F.unix_timestamp(F.col("ts").cast("timestamp")) < cut)
    late = ev.where(F.unix_timestamp(F.col("ts").cast("timestamp")) >= cut)
    store = RunningTotals(fresh_dir(spark, "t-inc"), ["ts", "event_id"], ["value"])
    assert store.append(early)["rewritten"] == 0 and _sorted(store.read(spark)) == _want(early)
    # the rows are read again only to sum up the buckets just written
    seen = []
    original = RunningTotals._rows
    monkeypatch.setattr(RunningTotals, "_rows", lambda self, s: seen.append(1) or original(self, s))
    got = store.append(late)
    assert got["rewritten"] == 0 and got["new"] > 0 and len(seen) == 1
    assert _sorted(store.read(spark)) == _want(ev)


def test_late_rows_rewrite_their_buckets_only(spark):
    ev = _events(spark)
    held = ev.where("event_id % 500 <> 3")
    store = RunningTotals(fresh_dir(spark, "t-inc2"), ["ts", "event_id"], ["value"])
    store.append(held)
    n = store.buckets(spark).count()
    one = ev.where("event_id % 500 = 3").orderBy("ts").limit(1)
    assert store.append(one) == {"rewritten": 1, "new": 0}
    rest = ev.where("event_id % 500 = 3")
    assert store.append(rest)["rewritten"] <= n  # the first row again: taken once
    assert _sorted(store.read(spark)) == _want(ev)
    before_all = spark.createDataFrame([(-1, "1900-01-01 00:00:00", 2.25)], "event_id long, ts string, value double").select(*ev.columns)
    assert store.append(before_all) == {"rewritten": 1, "new": 0}
    assert _sorted(store.read(spark)) == _want(ev.unionByName(before_all))


def test_an_increment_that_fails_does_not_count(spark, monkeypatch):
    rows = spark.range(100).selectExpr("id", "CAST(id AS DOUBLE) / 2 AS v")
    store = RunningTotals(fresh_dir(spark, "t-inc3"), ["id"], ["v"])
    store.append(rows.where("id < 50"))
    monkeypatch.setattr(snapshot, "write_table", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.append(rows.where("id >= 40"))
    monkeypatch.undo()
    assert store.read(spark).count() == 50
    store.append(rows.where("id >= 40"))
    got = {r.id: r.cum_v for r in store.read(spark).collect()}
    assert got == {i: round(sum(x / 2 for x in range(i + 1)), 2) for i in range(100)}


def test_nulls_and_values_beyond_the_exact_type(spark):
    rows = spark.createDataFrame([(1, None), (2, 1e30), (3, None), (4, 2.5), (5, 1e-15), (None, 3.0)], "id long, v double")
    store = RunningTotals(fresh_dir(spark, "t-inc4"), ["id"], ["v"])
    store.append(rows.where("id IS NULL OR id < 4"))
    store.append(rows.where("id >= 4"))
    want = {r.id: r.cum_v for r in running_total(rows, "id", ["v"]).collect()}
    assert {r.id: r.cum_v for r in store.read(spark).collect()} == want

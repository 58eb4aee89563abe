"""Drops with different headers: layouts, registration, drift, ledger."""

import time

import pytest
from pyspark.sql import functions as F

from fundlake.session import fresh_dir, local_path
from fundlake.sources import (create_layers, decode, drift, infer_types, layouts, list_files, pending, read_dates, record,
                              register_table, types_by_date, write_bronze)
from fundlake.sources.decode import cell_class
from fundlake.sources.discover import MixedDrop, ledger_events

ENTITY = "geo-breakdown"


def _land(spark, root, date, columns, *rows, mode="overwrite"):
    write_bronze(spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in columns)).coalesce(1), root, ENTITY, date, mode)


@pytest.fixture()
def drops(spark):
    root = fresh_dir(spark, "t-drift")
    _land(spark, root, "2026-01-01", ["region", "fmv_m", "company_count"], ("a,b", "20.5", "4"), ('say "x"\nnext', None, "5"))
    _land(spark, root, "2026-02-01", ["company_count", "region", "fmv_m"], ("4", "c", "20"))
    _land(spark, root, "2026-03-01", ["region", "company_count", "note"], ("d", "n/a", "7"))
    _land(spark, root, "2026-04-01", ["region", "company_count", "note"], ("e", "8", None))
    return root


WANT = [("2026-01-01", "a,b", "20.5", "4", None), ("2026-01-01", 'say "x"\nnext', None, "5", None), ("2026-02-01", "c", "20", "4", None),
        ("2026-03-01", "d", None, "n/a", "7"), ("2026-04-01", "e", None, "8", None)]
COLUMNS = ["load_date", "region", "fmv_m", "company_count", "note"]


def test_registered_drops_keep_their_columns(spark, drops):
    create_layers(spark, drops, ["driftdb"])
    t = register_table(spark, "driftdb", "geo", f"{drops}/{ENTITY}", "csv")
    assert sorted(map(tuple, t.select(*COLUMNS).collect()), key=str) == WANT
    # a new date in an old layout and one in a new layout are taken in; the view keeps its name
    _land(spark, drops, "2026-05-01", ["region", "fmv_m", "company_count"], ("f", "1", "1"))
    _land(spark, drops, "2026-06-01", ["other", "region"], ("o", "g"))
    t = register_table(spark, "driftdb", "geo", f"{drops}/{ENTITY}", "csv")
    got = {(r.load_date, r.region, r.fmv_m, r.other) for r in spark.table("driftdb.geo").where("load_date >= '2026-05'").collect()}
    assert got == {("2026-05-01", "f", "1", None), ("2026-06-01", "g", None, "o")} and t.count() == 7


def test_read_dates_unites_by_name_and_plan_follows_layouts(spark, drops):
    df = read_dates(spark, f"{drops}/{ENTITY}")
    assert sorted(map(tuple, df.select(*COLUMNS).collect()), key=str) == WANT
    some = read_dates(spark, f"{drops}/{ENTITY}", ["2026-03-01", "2026-04-01"])
    assert some.count() == 2 and "fmv_m" not in some.columns
    assert some._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert read_dates(spark, f"{drops}/{ENTITY}", ["2020-01-01"]) is None


def test_headers_may_differ_within_one_date(spark, drops):
    _land(spark, drops, "2026-04-01", ["fmv_m", "region"], ("9", "mixed"), mode="append")
    found = {x.columns: x for x in layouts(spark, [f"{drops}/{ENTITY}"])}
    assert len(found[("fmv_m", "region")].files) == 1 and len(found[("region", "company_count", "note")].files) == 1
    df = read_dates(spark, f"{drops}/{ENTITY}")
    assert ("2026-04-01", "mixed", "9", None, None) in {tuple(r) for r in df.select(*COLUMNS).collect()} and df.count() == 6
    with pytest.raises(MixedDrop):
        register_table(spark, "default", "geo_mixed", f"{drops}/{ENTITY}", "csv")


def test_drift_report(spark, drops):
    path = f"{drops}/{ENTITY}"
    types = types_by_date(read_dates(spark, path), layouts(spark, [path]))
    got = {(r.load_date, r.column_name): (r.change, r.old_type, r.new_type) for r in drift(types).collect()}
    assert got == {("2026-02-01", "fmv_m"): ("retyped", "double", "bigint"), ("2026-03-01", "fmv_m"): ("removed", "bigint", None),
                   ("2026-03-01", "note"): ("added", None, "bigint"), ("2026-03-01", "company_count"): ("retyped", "bigint", "string"),
                   ("2026-04-01", "company_count"): ("retyped", "string", "bigint")}


def test_ledger_logs_new_changed_and_deleted_files(spark, drops):
    import os
    path, ledger = f"{drops}/{ENTITY}", f"{drops}/_ledger"

    def events():
        found = pending(spark, path, ledger)
        rows = {(r.load_date, r.event) for r in found.collect()}
        record(found, ledger)
        return rows

    assert events() == {(f"2026-0{m}-01", "added") for m in (1, 2, 3, 4)}
    assert events() == set()
    _land(spark, drops, "2026-02-01", ["company_count", "region", "fmv_m"], ("5", "c2", "21"))  # another file replaces it
    first = list_files(spark, path).where("load_date = '2026-01-01'").first().path
    with open(local_path(first), "a") as f:
        f.write("z,1,1\n")
    crc = os.path.join(os.path.dirname(local_path(first)), "." + os.path.basename(first) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert events() == {("2026-01-01", "changed"), ("2026-02-01", "added"), ("2026-02-01", "deleted")}
    assert events() == set()
    assert {(r.event, r.seq) for r in ledger_events(spark, ledger).where("load_date = '2026-02-01'").collect()} == {("added", 1), ("added", 2), ("deleted", 2)}


def test_codes_are_not_numbers(spark):
    """A type suffix or hexadecimal is text; signs, points, exponents, nan and infinity are numbers."""
    df = spark.createDataFrame([("12D", "0x1p3", "1e3", "7", "nan"), ("7f", "1", "-.5", " 8 ", "-Infinity"), ("1.d", "2", "+4.", "9", "")],
                               "a string, b string, c string, d string, e string")
    kinds = {r["column_name"]: r["inferred_type"] for r in infer_types(df).collect()}
    assert kinds == {"a": "string", "b": "string", "c": "double", "d": "bigint", "e": "double"}
    assert [tuple(r)[:4] for r in decode(df).collect()] == [("12D", "0x1p3", 1000.0, 7), ("7f", "1", -0.5, 8), ("1.d", "2", 4.0, 9)]
    forced = decode(df, {"a": "double", "b": "double"}).select(F.col("a"), F.col("b")).collect()
    assert [r.a for r in forced] == [None] * 3 and [r.b for r in forced] == [None, 1.0, 2.0]
    from fundlake.functions.casting import lenient_cast
    from pyspark.sql import types as T
    assert [r[0] for r in df.select(lenient_cast("a", T.DoubleType())).collect()] == [None] * 3
    assert [r[0] for r in df.select(lenient_cast(F.col("c"), T.DoubleType())).collect()] == [1000.0, -0.5, 4.0]


def test_looking_at_text_costs_no_more_than_casting_numbers(spark):
    # a cast that fails throws and catches an exception, many times the cost of one that succeeds
    names = [f"c{i}" for i in range(6)]
    seconds = {}
    for kind, cell in (("bigint", "CAST(id AS STRING)"), ("string", "concat('1-row ', CAST(id AS STRING))")):
        path = fresh_dir(spark, "cells")
        spark.range(200_000).repartition(4).selectExpr(*[f"{cell} AS {c}" for c in names]).write.parquet(path)
        df = spark.read.parquet(path)
        for _ in range(3):
            begin = time.perf_counter()
            assert {r["inferred_type"] for r in infer_types(df).collect()} == {kind}
            seconds[kind] = min(seconds.get(kind, 1e9), time.perf_counter() - begin)
    assert seconds["string"] < 4 * seconds["bigint"] + 0.5


def test_cells_are_classed_as_their_casts_say(spark):
    edges = ["", " ", "\t", "\n", "\x00", "\x7f", "\x85", "\xa0", "\u2028", "x", "-", "+"]
    bodies = ["1", "12D", "1e5", "1.e5", ".5", ".", "1e", "1-URGENT", "0x1p3", "iNf", "Infinity", "nan", "1.0", "9" * 19, "1_0", "\u0661", "tRue", "a"]
    df = spark.createDataFrame([(a + sign + b + c,) for a in edges for sign in ("", "-") for b in bodies for c in edges], "x string")
    number = "CASE WHEN x NOT RLIKE '[0-9.][dDfF][ ]*$|[xX]' THEN try_cast(x AS DOUBLE) END"
    plain = (f"CASE WHEN try_cast(x AS BIGINT) IS NOT NULL THEN 6 WHEN ({number}) IS NOT NULL THEN 4 "
             "WHEN lower(trim(x)) IN ('true', 'false') THEN 1 ELSE 0 END")
    assert df.selectExpr("x", f"{plain} AS a", f"{cell_class('x')} AS b").where("NOT (a <=> b)").collect() == []

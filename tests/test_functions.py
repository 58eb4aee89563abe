import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.functions import (bucketize_expr, exact_round, exact_sum, first_match_expr,
                                lenient_cast, safe_div)


def test_exact_round_half_up_and_specials(spark):
    df = spark.createDataFrame([(1.005,), (-2.345,), (float("nan"),), (None,), (2.5,)], "x double")
    got = [r[0] for r in df.select(exact_round("x", 2)).collect()]
    assert got[0] == 1.01 and got[1] == -2.35 and math.isnan(got[2]) and got[3] is None
    assert df.select(exact_round("x", 0)).collect()[4][0] == 3.0


def test_exact_sum_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    a = spark.createDataFrame(vals, "x double").repartition(7).agg(exact_sum("x")).first()[0]
    b = spark.createDataFrame(vals[::-1], "x double").coalesce(1).agg(exact_sum("x")).first()[0]
    assert a == b == 600.0


def test_lenient_cast_malformed_text_is_null(spark):
    df = spark.createDataFrame([("",), ("abc",), ("12.0",), ("7",), (None,)], "s string")
    ints = [r[0] for r in df.select(lenient_cast("s", T.IntegerType())).collect()]
    assert ints == [None, None, 12, 7, None]
    bools = spark.createDataFrame([("1",), ("0",), ("",), ("2",)], "s string").select(
        lenient_cast("s", T.BooleanType())).collect()
    assert [r[0] for r in bools] == [True, False, None, None]
    d = spark.createDataFrame([("2024-01-05",), ("bad",)], "s string").select(
        lenient_cast("s", T.DateType())).collect()
    assert str(d[0][0]) == "2024-01-05" and d[1][0] is None


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, None, 1.5]


def test_bucketize_edges_and_null_placement(spark):
    df = spark.createDataFrame([(3.0,), (3.01,), (None,)], "x double")
    lab = bucketize_expr("x", [3.0], ["low", "high"], "right")
    assert [r[0] for r in df.select(lab).collect()] == ["low", "high", "high"]
    lab2 = bucketize_expr("x", [3.0], ["low", "high"], "left", null_label="n/a")
    assert [r[0] for r in df.select(lab2).collect()] == ["high", "high", "n/a"]


def test_first_match_null_condition_falls_through(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "x double")
    e = first_match_expr([(F.col("x") > 1, "big")], "other")
    assert [r[0] for r in df.select(e).collect()] == ["other", "big"]


def test_sums_drop_nothing(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum("x")).first()[0]
    assert total(*[4e-7] * 5) == 2e-6
    assert total(*[4e-17] * 5) == 2e-16 and total(1e33, 1.0) == 1e33
    assert math.isnan(total(1.0, float("nan"))) and total(1.0, float("inf")) == float("inf")
    assert total(None, None) is None and total(None, 2.5) == 2.5


def test_rounding_happens_once(spark):
    df = spark.createDataFrame([(1.0049999,), (0.0049996,), (1e33,), (1.005,)], "x double")
    assert [r[0] for r in df.select(exact_round("x", 2)).collect()] == [1.0, 0.0, 1e33, 1.01]


def test_large_ids_keep_every_digit(spark):
    df = spark.createDataFrame([("9007199254740993",), ("9007199254740992",), ("12.0",), ("12.7",),
                                ("x",)], "s string")
    got = [r[0] for r in df.select(lenient_cast("s", T.LongType())).collect()]
    assert got == [9007199254740993, 9007199254740992, 12, 12, None]

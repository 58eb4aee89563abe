"""A key holding a third of all rows: keyed operators must collapse it on the
map side (partial aggregation below the exchange) and stay correct."""

from pyspark.sql import functions as F

from fundlake.operators import band_summary, cagr, latest_per_key
from fundlake.operators.returns import dated_flows


def _hot(spark, n=3000):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        (F.col("id") % 7 + 2000).cast("int").alias("year"),
        (F.col("id") % 11).cast("double").alias("v"),
        F.expr("date_add(DATE'2020-01-01', CAST(id % 30 AS INT))").alias("d"))


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(plan: str, fn: str) -> bool:
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    return any(f"partial_{fn}" in ln for i in ex for ln in lines[i + 1:i + 3])


def test_latest_per_key_partial_aggregation(spark):
    df = latest_per_key(_hot(spark), "k", "year", cols=["year", "v"])
    assert _partial_before_exchange(_plan(df), "max_by")
    top = df.where("k = 0").first()
    assert (top["year"], top["v"]) == (2006, 10.0)


def test_cagr_partial_aggregation(spark):
    df = cagr(_hot(spark), "k", "year", "v", keep_parts=True)
    assert _partial_before_exchange(_plan(df), "min")


def test_band_summary_partial_aggregation(spark):
    df = band_summary(_hot(spark).withColumn("band", F.expr("IF(k = 0, 'hot', 'cold')")),
                      "band", sums={"s": "v"})
    assert _partial_before_exchange(_plan(df), "sum")
    got = {r["band"]: r["company_count"] for r in df.collect()}
    assert got == {"hot": 1000, "cold": 2000}


def test_irr_flows_are_netted_per_date_before_the_shuffle(spark):
    net = dated_flows(_hot(spark), "k", "d", "v")
    assert _partial_before_exchange(_plan(net), "sum")
    assert net.where("key = 0").count() == 10   # one row per calendar date (id % 30, id % 3 == 0)


def test_skew_safe_growth_equals_window_growth(spark):
    from fundlake.operators import growth
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17 + 1).alias("k"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise((F.col("id") % 29) - 7.5)
         .cast("double").alias("x"))
    plain = {r["t"]: r["x_g"] for r in growth(df, "k", "t", ["x"], out=["x_g"]).collect()}
    safe = {r["t"]: r["x_g"] for r in growth(df, "k", "t", ["x"], out=["x_g"],
                                             skew_safe=True).collect()}
    assert safe == plain and sum(v is not None for v in plain.values()) > 500


def test_distributed_lag_across_many_boundaries(spark):
    from fundlake.operators import distributed_lag
    df = spark.range(700).select(
        F.when(F.col("id") < 400, F.lit(5)).otherwise(F.col("id") % 9).alias("k"),
        (F.col("id") % 50).alias("t"), F.col("id").alias("tb"),
        (F.col("id") * 1.5).alias("x"))
    got = {r["tb"]: r["_prev_x"] for r in distributed_lag(
        df, "k", "t", ["x"], tiebreak=["tb"], partitions=7).collect()}
    rows = sorted(((r["k"], r["t"], r["tb"], r["x"]) for r in df.collect()))
    exp, prev = {}, None
    for k, t, tb, x in rows:
        exp[tb] = prev[1] if prev is not None and prev[0] == k else None
        prev = (k, x)
    assert got == exp

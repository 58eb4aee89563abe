"""Running totals that continue: new rows read stored bucket totals, not the old rows.

The rows lie in buckets, ranges of the total order.  A row is stored with its
running sum inside its bucket, and a small table keeps each bucket's lowest and
highest key and its total.  The running total of a row is its bucket's offset
(the totals before it) plus the stored sum, so

* rows after all stored ones become new buckets: nothing old is read;
* a late row rewrites its own bucket only; later buckets' totals move with
  their offsets.

The bucket table is published as a snapshot (``sources.snapshot``) and names the
run that wrote each bucket's rows, so an increment counts whole or not at all,
and repeating one changes nothing: rows with keys that are already there are
taken once.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.numeric import q, sql_exact, sql_inexact
from fundlake.operators.series import range_buckets
from fundlake.sources.snapshot import LayerRun, current

_STATE = "buckets"


@dataclass(frozen=True)
class RunningTotals:
    """Stored running totals of ``cols`` in the order of ``keys`` (unique together) below ``root``."""

    root: str
    keys: Sequence[str]
    cols: Sequence[str]
    scale: int = 2

    def _key(self) -> str:
        return f"struct({', '.join(q(k) for k in self.keys)})"

    def _values(self) -> dict[str, str]:
        """Exact sums, and double sums of what does not fit the exact type."""
        return {f"{c}{kind}": e for c in self.cols for kind, e in (
            ("", f"CASE WHEN NOT {sql_inexact(q(c))} THEN {sql_exact(q(c))} END"),
            ("_rest", f"CASE WHEN {sql_inexact(q(c))} THEN CAST({q(c)} AS DOUBLE) END"))}

    def buckets(self, spark: SparkSession) -> DataFrame | None:
        """(bucket, run, low, high, n, t_<col>, ...): one row per bucket; None before the first increment."""
        now = current(spark, self.root)
        return now.read(spark, _STATE) if now else None

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/rows")

    def _placed(self, new: DataFrame, state: DataFrame | None) -> tuple[DataFrame, list[tuple[int, str]]]:
        """(rows with ``bucket``, the old buckets among them with their runs); old buckets' rows are part of the result."""
        spark = new.sparkSession
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if state is None:
            return range_buckets(new, self.keys, n).withColumnRenamed("_part", "bucket"), []
        # the bounds of all buckets: one row each, as a scalar subquery
        lows = state.agg(F.sort_array(F.collect_list(F.struct("low", "bucket"))).alias("s")).select("s").scalar()
        high = state.agg(F.max("high").alias("h")).select("h").scalar()
        base = state.agg(F.max("bucket").alias("b")).first()["b"] + 1
        marked = new.withColumn("_lows", lows).withColumn("_late", F.expr(self._key()) <= high)
        steps = ", ".join(str(1 << i) for i in range(max(base, 1).bit_length(), -1, -1))
        at = (f"aggregate(array({steps}), 0, (low, step) -> IF(low + step <= size(_lows) "
              f"AND get(_lows, low + step - 1).low <= {self._key()}, low + step, low))")
        # a row below all bounds belongs to the first bucket
        late = (marked.where("_late").withColumn("bucket", F.expr(f"get(_lows, greatest({at} - 1, 0)).bucket"))
                .select(*new.columns, "bucket"))
        fresh = range_buckets(marked.where("NOT _late").select(*new.columns), self.keys, n)
        fresh = fresh.withColumn("bucket", (F.col("_part") + base).cast("long")).drop("_part")
        # at most one row per stored bucket
        touched = late.select("bucket").distinct().join(state, "bucket").select("bucket", "run").collect()
        old = sorted((r["bucket"], r["run"]) for r in touched)
        rows = late.unionByName(fresh)
        if old:
            where = functools.reduce(lambda a, b: a | b, [(F.col("bucket") == b) & (F.col("run") == r) for b, r in old])
            stored = self._rows(spark).where(where).select(*new.columns, F.col("bucket").cast("long").alias("bucket"))
            rows = rows.unionByName(stored)
        return rows, old

    def append(self, new: DataFrame) -> dict[str, int]:
        """Take ``new`` rows in; how many stored buckets were rewritten and how many are new.

        The columns must be those of the first increment.  Rows whose keys are
        stored already are dropped (their bucket is written again).
        """
        spark = new.sparkSession
        state = self.buckets(spark)
        rows, old = self._placed(new.select(*new.columns), state)
        run = LayerRun(spark, self.root)
        values = self._values()
        order = ", ".join(f"{q(k)} ASC NULLS FIRST" for k in self.keys)
        inside = f"OVER (PARTITION BY bucket ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        once = rows.dropDuplicates(["bucket", *self.keys]).withColumns({f"_v_{k}": F.expr(e) for k, e in values.items()})
        summed = once.withColumns({f"_cum_{k}": F.expr(f"sum(`_v_{k}`) {inside}") for k in values}).drop(*[f"_v_{k}" for k in values])
        path = f"{self.root.rstrip('/')}/rows"
        summed.withColumn("run", F.lit(run.run_id)).write.mode("append").partitionBy("run", "bucket").parquet(path)
        written = self._rows(spark).where(F.col("run") == run.run_id).select(*new.columns, F.col("bucket").cast("long").alias("bucket"), "run")
        totals = [F.expr(f"sum({e})").alias(f"t_{k}") for k, e in values.items()]
        key = F.expr(self._key())
        after = written.groupBy("bucket", "run").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n"), *totals)
        if state is not None:
            after = after.unionByName(state.where(~F.col("bucket").isin([b for b, _ in old])) if old else state)
        run.write(after.coalesce(1), _STATE)
        run.commit()
        return {"rewritten": len(old), "new": self.buckets(spark).where(F.col("run") == run.run_id).count() - len(old)}

    def read(self, spark: SparkSession, prefix: str = "cum_") -> DataFrame:
        """All rows with ``<prefix><col>``: as :func:`running_total` over the whole table gives them."""
        before = "OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        offsets = self.buckets(spark).selectExpr("bucket", "run", *[f"sum(`t_{k}`) {before} AS `_o_{k}`" for k in self._values()])
        rows = self._rows(spark).withColumn("bucket", F.col("bucket").cast("long"))
        # one row per bucket; also prunes the partitions of runs that no longer count
        joined = rows.join(F.broadcast(offsets), ["bucket", "run"])
        total = {k: f"CASE WHEN `_cum_{k}` IS NULL THEN `_o_{k}` ELSE coalesce(`_o_{k}`, 0) + `_cum_{k}` END" for k in self._values()}
        plain = [c for c in rows.columns if c not in ("bucket", "run") and not c.startswith("_cum_")]
        sums = joined.selectExpr(*[q(c) for c in plain], *[f"{e} AS `_t_{k}`" for k, e in total.items()])
        return sums.selectExpr(*[q(c) for c in plain], *[
            f"CASE WHEN `_t_{c}_rest` IS NULL THEN CAST(round(`_t_{c}`, {self.scale}) AS DOUBLE) ELSE "
            f"round(coalesce(CAST(`_t_{c}` AS DOUBLE), 0D) + `_t_{c}_rest`, {self.scale}) END AS {q(prefix + c)}" for c in self.cols])

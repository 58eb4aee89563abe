"""Columnar layers: Parquet sink with a row count (S4, S5); for the scan see ``snapshot``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, root: str, name: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                cluster_by: Sequence[str] = (), bloom_by: Sequence[str] = ()) -> int:
    """Write Parquet and return the row count from the same job.

    No ``coalesce(1)``: the write keeps the plan's parallelism (AQE sizes
    the last shuffle).  The count is an ``Observation`` of the write itself,
    taken above its last exchange, so the sampling that finds range bounds
    is not counted.  ``cluster_by`` range-partitions
    and sorts the rows on a lookup key, so each file and row group covers a
    narrow key range and a point filter skips the rest by min/max
    statistics; ``sort_within`` only sorts inside each task's output.
    ``bloom_by`` names columns that are looked up by value but do not order the
    table: each row group gets a Bloom filter of them, so a filter on equality
    skips the row groups that lack the value.
    """
    obs = Observation(f"rows_{name}")
    out = df
    if cluster_by:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(n, *cluster_by).sortWithinPartitions(*cluster_by)
    elif sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    for c in bloom_by:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{root.rstrip('/')}/{name}")
    return int(obs.get["rows"])

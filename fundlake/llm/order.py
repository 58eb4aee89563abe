"""Places of rows in their group's order, without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged


def group_key(column: Column) -> Column:
    """A text that sorts as the column's text does, bytewise, null first, and never is null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` and a number of each (``row``); stage the result before it is used twice."""
    return rows.withColumn("row", F.monotonically_increasing_id())


def placed(rows: DataFrame, group: str, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` (a staged table) with ``pos``, the place from 0 in its group, and ``n``, the group's size.

    Rows are dealt by ranges of (group, keys), so a group of any size spreads
    over as many tasks as it fills; what a task holds of a group is counted, and
    a running sum over those counts (at most one for each task and group)
    gives every task its first place.  ``keys`` must end in a column that
    differs between equal rows (``numbered``), so that they spread too.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(group), *[F.col(k).asc_nulls_first() for k in keys]]
    dealt = staged(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), f"{name}-dealt")
    parts = dealt.groupBy(group, "part").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    by_group = Window.partitionBy(group)
    before = F.coalesce(F.sum("held").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = staged(parts.select(group, "part", "first", before.alias("before"), F.sum("held").over(by_group).alias("n")), f"{name}-offsets")
    return (dealt.join(offsets, [group, "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
            .select(*rows.columns, "pos", "n"))

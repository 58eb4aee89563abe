"""Connected components of a link table, in Spark: parents are lowered until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node that links reach.

    Each round gives every node that has links, and the root it hangs on, the
    smallest grandparent among its neighbours, and shortens all paths by half.
    Then a link goes on between the grandparents of its ends: it is dropped once
    they are equal, and links between the same two become one.  So the links of a
    group that hangs together are read once, not in every round.  A node whose
    parent changes stays tied to its old one by the links so moved.  Rounds grow
    with the logarithm of the longest path.  Every table is written to the shared
    folder, minima combine map-side, so a hub costs one row per task.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-both")
    tree = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("parent")), f"{name}-tree")
    while True:
        up = tree.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        known = tree.join(up, "parent").select("node", "parent", "grand")
        far = known.select(F.col("node").alias("b"), F.col("grand").alias("low"))
        near = known.select(F.col("node").alias("a"), "parent", "grand")
        open_ = staged(both.join(far, "b").join(near, "a").where("low != grand").select("a", "parent", "grand", "low"), f"{name}-open")
        nothing = F.lit(None).cast("long").alias("old")
        offer = known.select("node", F.col("grand").alias("parent"), F.col("parent").alias("old")).unionByName(
            open_.select(F.explode(F.array("a", "parent")).alias("node"), F.col("low").alias("parent"), nothing)).unionByName(
            known.select(F.col("parent").alias("node"), F.col("grand").alias("parent"), nothing))
        new = staged(offer.groupBy("node").agg(F.min("parent").alias("parent"), F.max("old").alias("old")), f"{name}-tree")
        if new.where("parent != old").isEmpty():
            return new.select("node", F.col("parent").alias("component"))
        tree = new.select("node", "parent")
        both = open_.select(F.col("grand").alias("a"), F.col("low").alias("b")).distinct()

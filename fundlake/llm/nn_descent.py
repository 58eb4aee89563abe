"""Embedding near-dedup by NN-descent: a neighbour graph refined through neighbours of neighbours.

Only vectors of equal, non-null label and equal length are compared, by cosine
in double precision.  Equal vectors of a label collapse into a class with a
count first.

1. Start: every class takes neighbours from the buckets it falls into by the
   signs of random projections, several tables of them; crowded buckets are
   dealt into parts of bounded size.
2. Refinement: the neighbours of a class, and the classes that list it, are
   compared with each other; lists keep the ``K`` best; this repeats until few
   lists change.  Neighbours under ``FLOOR`` are not listed: no link leads
   through them.
3. Saturation: a list full of links may be too short.  Such lists are enlarged,
   twice as long each time, and filled again from buckets and the neighbours of
   neighbours, until a list ends under the threshold or is ``LONGEST``.  What is full even
   then (groups of more near copies than that) is compared with each other
   exactly, in tiles of bounded size, so that links which the lists cut join their
   components; then links are counted over each whole component, again in
   tiles.  Nothing is capped there.  The tiles grow with the square of what stays
   full in a label, and of a component.
4. Audit: up to ``AUDIT`` classes, those with the smallest hash, are compared
   with all vectors in blocks.  Recall is the mean of the classes' own recalls,
   once with equal weights and once with a group's classes sharing one weight,
   so that a large clique hides nothing.  Below ``RECALL`` in either, the graph
   is built again with twice the tables, up to ``TRIES`` times; after that all
   classes of a label are compared with each other exactly, in tiles.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components, or whose label is null, has no links and is its own component; so
is a row without vec_id (its component is null, it is kept); rows that share a
vec_id are vectors of their own, each with its own links and component, named
by the smallest vec_id in it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_column, importable, staged
from .components import components

COSINE = 0.93
FLOOR = 0.75
#: Length of the lists at first, and of the longest ones.
K, LONGEST = 10, 40
TABLES = 14
#: Vectors of one bucket part or tile block; mean size that buckets are aimed at.
PART, AIM = 1024, 24
ROUNDS, SETTLED = 6, 0.01
AUDIT, RECALL, TRIES = 1000, 0.98, 3
SEED = 11


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(node, first, place, label, v, n), staged: one row per distinct comparable vector of a label.

    ``node`` is its number, ``first`` its smallest vec_id, ``place`` a hash of its label and length.
    """
    rows = vectors.select(as_column(id_col).cast("long").alias("vec_id"), as_column(label_col).alias("label"),
                          F.transform(as_column(vector_col), lambda x: x.cast("double")).alias("v")).where(_comparable())
    return staged(rows.groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
                  .select(F.monotonically_increasing_id().alias("node"), "first", F.xxhash64("label", F.size("v")).alias("place"), "label", "v", "n"), "nn-classes")


def _comparable():
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array) -> np.ndarray:
    """The rows of a list column of one length, scaled to length one."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    rows = flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))
    rows = rows / np.abs(rows).max(axis=1, keepdims=True) if rows.size else rows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True) if rows.size else rows


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit rows) for each length of vectors in a batch."""
    lengths = np.diff(np.asarray(column.offsets))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, unit_rows(column.take(pa.array(at)))


def _buckets(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(bucket, place, node, unit): every class once per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, place = batch["node"].to_numpy(), batch["place"].to_numpy()
            for at, units in _by_length(batch["v"]):
                small = pa.array(list(units.astype(np.float32)), pa.list_(pa.float32()))
                for t in range(tables):
                    planes = np.random.default_rng([seed, t, units.shape[1]]).normal(size=(units.shape[1], bits))
                    code = (units @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64)) + (np.int64(t) << np.int64(bits))
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(place[at]), pa.array(node[at]), small], names=["bucket", "place", "node", "unit"])

    return classes.select("node", "place", "v").mapInArrow(run, "bucket long, place long, node long, unit array<float>")


def best_neighbours(nodes: np.ndarray, units: np.ndarray, k: int = K) -> tuple[list, list]:
    """(node, [(1 - cosine, other), ...]) of those with neighbours at FLOOR or above, the k best each."""
    cosines = (units @ units.T).astype(np.float64)
    np.fill_diagonal(cosines, -2)
    owners, lists = [], []
    for i in np.flatnonzero((cosines >= FLOOR).any(axis=1)):
        near = np.flatnonzero(cosines[i] >= FLOOR)
        near = near[np.argsort(-cosines[i, near], kind="stable")[:k]]
        owners.append(int(nodes[i]))
        lists.append([{"far": round(1 - float(cosines[i, j]), 5), "other": int(nodes[j])} for j in near])
    return owners, lists


_LIST = "array<struct<far: double, other: bigint>>"
_LIST_TYPE = pa.list_(pa.struct([("far", pa.float64()), ("other", pa.int64())]))


def _first_lists(classes: DataFrame, tables: int, seed: int, k: int = K) -> DataFrame:
    """(node, near): neighbours from all tables' buckets."""
    largest = classes.groupBy("place").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    bits = max(1, int(np.ceil(np.log2(max(largest / AIM, 2)))))
    spread = _buckets(classes, bits, tables, seed)
    sizes = staged(spread.groupBy("bucket", "place").agg(F.count("*").alias("size")).where(F.col("size") > PART), "nn-crowded")
    parts = F.coalesce(F.ceil(F.col("size") / PART), F.lit(1))
    dealt = spread.join(sizes, ["bucket", "place"], "left").withColumn("part", F.pmod(F.xxhash64("node", "bucket"), parts))
    count = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            owners, lists = best_neighbours(np.array([r[1] for r in held]), np.array([r[2] for r in held]), k)
            return pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(lists, _LIST_TYPE)], names=["node", "near"])

        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in ("bucket", "place", "part")), strict=True)
            units = batch["unit"]
            for key, node, unit in zip(keys, batch["node"].to_pylist(), units, strict=True):
                if held and (held[0][0] != key or len(held) >= 2 * PART):
                    yield flush()
                    held = []
                held.append((key, node, unit.values.to_numpy()))
        if held:
            yield flush()

    found = (dealt.repartition(count, "bucket", "place", "part").sortWithinPartitions("bucket", "place", "part")
             .select("bucket", "place", "part", "node", "unit").mapInArrow(run, f"node long, near {_LIST}"))
    return _merged(found, k)


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode("near").alias("x")).select("node", "x.far", "x.other")


def _nearest(entries: DataFrame, k: int) -> DataFrame:
    """(node, near): the ``k`` nearest of (node, far, other) for each node; the window's group limit cuts a hub's entries map-side."""
    ranked = entries.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy("far", "other"))).where(F.col("rank") <= k)
    return ranked.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("far", "other"))).alias("near"))


def _merged(lists: DataFrame, k: int = K) -> DataFrame:
    """One list per node: the ``k`` nearest of all its lists."""
    return _nearest(_entries(lists).groupBy("node", "other").agg(F.min("far").alias("far")), k)


def _listing(lists: DataFrame) -> DataFrame:
    """(node, far, other): for each node those that list it."""
    return _entries(lists).select(F.col("other").alias("node"), "far", F.col("node").alias("other"))


def _compared(around: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(node, near): the ``others`` around each node, compared with each other."""
    vectors = around.join(classes.select(F.col("node").alias("other"), "v"), "other")

    def run(group: pa.Table) -> pa.Table:
        own = group.combine_chunks()
        owners, lists = best_neighbours(own["other"].to_numpy(), unit_rows(own["v"].chunk(0)), k)
        return pa.table({"node": pa.array(owners, pa.int64()), "near": pa.array(lists, _LIST_TYPE)})

    return vectors.select("node", "other", "v").groupBy("node").applyInArrow(run, f"node long, near {_LIST}")


def _refined(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """One round of comparing the neighbours of every node, listed ones and listing ones, with each other."""
    around = lists.unionByName(_nearest(_listing(lists), K)).select("node", F.explode("near.other").alias("other")).distinct()
    return _merged(_compared(around, classes, K).unionByName(lists))


def _full(lists: DataFrame, k: int) -> DataFrame:
    """The nodes whose lists hold ``k`` links, so that further links may have been cut."""
    return lists.where((F.size("near") >= k) & (F.element_at("near", -1)["far"] <= 1 - COSINE + 1e-4)).select("node")


def enlarged(lists: DataFrame, classes: DataFrame, tables: int = TABLES, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(lists, nodes still full): lists full of links get twice the length until they end under the threshold or are LONGEST.

    A full node's new list comes from the buckets of full nodes, from its own list,
    from those that list it, and from comparing the neighbours of full nodes, two
    rounds at each length.  The buckets are needed: groups whose lists all filled
    with their own members have no common neighbour yet.
    """
    k = K
    full = staged(_full(lists, k), "nn-full")
    while k < LONGEST and not full.isEmpty():
        k = min(2 * k, LONGEST)
        fresh = _first_lists(classes.join(full, "node", "left_semi"), tables, seed + k, k)
        lists = staged(lists.join(full, "node", "left_anti").unionByName(_merged(fresh.unionByName(lists.join(full, "node", "left_semi")), k)), "nn-lists")
        for _ in range(2):
            own = lists.join(full, "node", "left_semi")
            listing = _nearest(_listing(lists).join(full, "node", "left_semi"), k)
            both = own.unionByName(listing)
            around = both.select("node", F.explode("near.other").alias("other")).unionByName(full.select("node", F.col("node").alias("other"))).distinct()
            found = _compared(around, classes, k).join(full, "node", "left_semi")
            lists = staged(lists.join(full, "node", "left_anti").unionByName(_merged(found.unionByName(both), k)), "nn-lists")
        full = staged(_full(lists, k), "nn-full")
    return lists, full


def _links_within(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, links): how many other vectors each class of a component links with, counted over all of it in tiles."""
    own = staged(classes.join(labels, "node"), "nn-linked")
    sizes = own.groupBy("component", "place").agg(F.ceil(F.count("*") / F.lit(PART)).alias("blocks"))
    dealt = own.join(sizes, ["component", "place"]).withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
    tiles = (dealt.select("component", "place", "node", "v", "n", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
             .select("component", "place", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "v", "n"))

    def run(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        units, n, block = unit_rows(tile["v"].chunk(0)), tile["n"].to_numpy(), tile["block"].to_numpy()
        links = np.zeros(len(n), np.int64)
        for a in range(0, len(n), 512):
            linked = units[a:a + 512] @ units.T >= COSINE
            if tile["i"][0].as_py() != tile["j"][0].as_py():
                linked &= block[a:a + 512, None] != block[None, :]
            else:
                linked[np.arange(linked.shape[0]), np.arange(a, a + linked.shape[0])] = False
            links[a:a + 512] = linked @ n
        return pa.table({"node": tile["node"], "links": pa.array(links)})

    each = tiles.groupBy("component", "place", "i", "j").applyInArrow(run, "node long, links long")
    return each.groupBy("node").agg(F.sum("links").alias("links"))


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what all links of a square 0/1 matrix join, at most one per row."""
    fresh, out = np.ones(len(linked), bool), []
    for first in range(len(linked)):
        todo = [first] if fresh[first] else []
        fresh[first] = False
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & fresh)
            fresh[new] = False
            out += [(i, int(j)) for j in new]
            todo += new.tolist()
    return out


def _exact_edges(classes: DataFrame) -> DataFrame:
    """(a, b): links that join all of ``classes`` that links join, by comparing those of a place with each other in tiles."""
    own = staged(classes.select("place", "node", "v"), "nn-compared")
    sizes = own.groupBy("place").agg(F.ceil(F.count("*") / F.lit(PART)).alias("blocks"))
    dealt = own.join(sizes, "place").withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
    tiles = (dealt.select("place", "node", "v", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
             .select("place", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "v"))

    def run(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        units, node = unit_rows(tile["v"].chunk(0)), tile["node"].to_numpy()
        pairs = np.array(_forest(units @ units.T >= COSINE), np.int64).reshape(-1, 2)
        ends = node[pairs]
        return pa.table({"a": pa.array(ends.min(axis=1), pa.int64()), "b": pa.array(ends.max(axis=1), pa.int64())})

    return tiles.groupBy("place", "i", "j").applyInArrow(run, "a long, b long")


def _edges(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): listed pairs whose cosine, computed again in double precision, reaches COSINE."""
    pairs = (lists.select("node", F.explode("near").alias("x")).where(F.col("x.far") <= 1 - COSINE + 1e-4)
             .select(F.least("node", "x.other").alias("a"), F.greatest("node", "x.other").alias("b")).distinct())
    both = (pairs.join(classes.select(F.col("node").alias("a"), F.col("v").alias("of_a")), "a")
            .join(classes.select(F.col("node").alias("b"), F.col("v").alias("of_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(len(batch), bool)
            for at, units in _by_length(batch["of_a"]):
                good[at] = np.einsum("ij,ij->i", units, unit_rows(batch["of_b"].take(pa.array(at)))) >= COSINE
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def audit(classes: DataFrame, links: DataFrame, size: int = AUDIT) -> float:
    """Recall of the links of up to ``size`` classes, found out by comparing them with every vector.

    The lower of two means of found / there: over the audited classes that have
    links, and over the same weighted by 1 / there.
    """
    asked = classes.orderBy(F.xxhash64("label", "v"), "first").limit(size).select("node", "place", "v").collect()
    groups = {}
    for place in {r.place for r in asked}:
        rows = [r for r in asked if r.place == place]
        groups[place] = (np.array([r.node for r in rows]), unit_rows(pa.array([r.v for r in rows], pa.list_(pa.float64()))))
    shared = classes.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, place, n = (batch[c].to_numpy() for c in ("node", "place", "n"))
            out: dict[int, int] = {}
            for at, units in _by_length(batch["v"]):
                for p in np.unique(place[at]):
                    if p in shared.value:
                        own = np.flatnonzero(place[at] == p)
                        nodes, queries = shared.value[p]
                        near = (queries @ units[own].T >= COSINE) & (nodes[:, None] != node[at][own][None, :])
                        for q, links in zip(nodes.tolist(), (near @ n[at][own]).tolist(), strict=True):
                            out[q] = out.get(q, 0) + links
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.int64())], names=["node", "there"])

    there = classes.select("node", "place", "v", "n").mapInArrow(run, "node long, there long").groupBy("node").agg(F.sum("there").alias("there"))
    recall = F.coalesce("links", F.lit(0)) / F.col("there")
    row = (there.where("there > 0").join(links, "node", "left")
           .agg(F.avg(recall), F.sum(recall / F.col("there")) / F.sum(1 / F.col("there"))).first())
    return min(row[0], row[1]) if row[0] is not None else 1.0


def _joined(edges: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(component of every class with links, links of every such class)."""
    labels = components(staged(edges, "nn-edges"), "nn")
    return labels, staged(_links_within(classes, labels), "nn-counted")


def neighbour_graph(classes: DataFrame, tables: int = TABLES, seed: int = SEED) -> DataFrame:
    """(node, near): the refined lists of all classes that have neighbours at FLOOR or above."""
    lists = staged(_first_lists(classes, tables, seed), "nn-lists")
    for _ in range(ROUNDS):
        new = staged(_refined(lists, classes), "nn-lists")
        same = new.join(lists, ["node", "near"], "left_semi").count()
        total = new.count()
        lists = new
        if total - same <= SETTLED * total:
            break
    return lists


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) of every row; recall is the audit's figure, 1 after an exact comparison."""
    importable(vectors.sparkSession)
    classes = _classes(vectors, id_col, vector_col, label_col)
    tables = TABLES
    for attempt in range(TRIES):
        lists, full = enlarged(neighbour_graph(classes, tables, SEED + attempt), classes, tables, SEED + attempt)
        labels, counted = _joined(_edges(lists, classes).unionByName(_exact_edges(classes.join(full, "node", "left_semi"))), classes)
        recall = audit(classes, counted)
        if recall >= RECALL:
            break
        tables *= 2
    else:
        labels, counted = _joined(_exact_edges(classes), classes)
        recall = 1.0
    named = labels.join(classes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("lowest"))
    whole = (classes.join(counted, "node", "left").join(labels, "node", "left").join(named, "component", "left")
             .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("lowest", "first").alias("component")))
    rows = vectors.select(as_column(id_col).cast("long").alias("vec_id"), as_column(label_col).alias("label"),
                          F.transform(as_column(vector_col), lambda x: x.cast("double")).alias("v"))
    good = rows.where(_comparable()).join(whole, ["label", "v"]).select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.where(~_comparable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
                                          F.lit(float(recall)).alias("recall"))

"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

A text's set holds its distinct five-word shingles (see ``shingles``).  Its
sketch has ``COORDINATES`` bins: in every round each shingle is hashed to a bin
and a value, and a bin keeps the smallest (round, value) it ever gets; after as
many rounds as there are bins, round ``COORDINATES + b`` fills bin b alone, so
every bin of a non-empty set is filled.  Two sketches agree in a bin with a
probability of the sets' resemblance.  Runs of ``ROWS`` bins form bands; sets
that share a band are candidates, and a candidate is a link once the full sets
confirm 100 * |intersection| >= 75 * |union|.

Linking goes by components, so no group is compared all with all:

1. equal sets collapse into a class first;
2. in a band's bucket of at most ``SMALL`` classes all pairs are candidates; each
   class verifies its likeliest one first, and afterwards only those that lie in
   another component;
3. a larger bucket has one centre, its class of the smallest hash, so that a
   family of near copies has the same centre in most of its bands.  Each
   class takes one of its large buckets and verifies its centre: one pair per
   class, however many bands it shares.  What lies apart afterwards takes another
   bucket and centre, ``ROUNDS`` times;
4. the classes of larger buckets that still lie in several components are
   compared exactly, in tiles of bounded size, and only links that join
   components are put out.  So centres lose nothing.

A set pair at resemblance 0.75 misses all 36 bands with a probability of 1e-6,
and less above.

Defined cases: a null, empty or wordless text has an empty set, links with
nothing and is its own component; fewer than five words form one shingle;
component ids are the smallest doc_id, a row without doc_id takes its class's
(null if no row of the class has one) and is kept only then; rows that share a
doc_id are judged by their own texts, each in its own group (groups with the
same smallest doc_id have the same id); extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_column, blocks, free_names, importable, staged, text_or_empty, utf8_buffers
from .components import components
from .shingles import WIDTH, mix, seeds, shingle_sets

ROWS, BANDS = 4, 36
COORDINATES = ROWS * BANDS
#: Links are pairs with PERCENT * |union| <= 100 * |intersection|.
PERCENT = 75
#: Buckets up to this size give all their pairs, larger ones a pair with their centre for each class, then once more in so many rounds.
SMALL, ROUNDS = 16, 1
#: Bytes of shingle hashes in one block of a tile.
TILE_BYTES = 4 << 20

_ROUND = seeds(2 * COORDINATES, 10_000)
_COORDINATE = seeds(COORDINATES, 20_000)
_LOW = np.uint64(0xFFFFFFFF)
_OPEN = np.uint64(2**64 - 1)


def sketch(shingles: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """The sketch of a non-empty set: for each bin the smallest (round, value) it gets."""
    bins = np.full(size, _OPEN)
    done = 0
    while done < size and (bins == _OPEN).any():
        # several rounds at once for small sets: later rounds never replace an earlier one's value
        rounds = min(size - done, max(1, 8 * size // len(shingles)))
        hashes = mix(shingles[None, :] ^ _ROUND[done:done + rounds, None])
        at = ((hashes >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        values = (hashes & _LOW) | (np.arange(done, done + rounds, dtype=np.uint64)[:, None] << np.uint64(32))
        np.minimum.at(bins, at.ravel().astype(np.intp), values.ravel())
        done += rounds
    for b in np.flatnonzero(bins == _OPEN):
        bins[b] = (mix(shingles ^ _ROUND[size + b]) & _LOW).min() | (np.uint64(size + b) << np.uint64(32))
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per band, different for every band."""
    return mix((mix(bins ^ _COORDINATE)).reshape(BANDS, ROWS) @ seeds(ROWS, 30_000)).view(np.int64)


def sets_of(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    data, offsets = utf8_buffers(texts)
    for a, b in blocks(offsets):
        yield from shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)


def _set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, n_shingles, set_key, bands) of every row of ``docs`` (doc_id, tag, text); empty sets have no key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, bands = [], [], []
            for found in sets_of(batch["text"]):
                sizes.append(len(found))
                keys.append(_set_key(found) if len(found) else None)
                bands.append(band_keys(sketch(found)).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["tag"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.binary())],
                names=["doc_id", "tag", "n_shingles", "set_key", "bands"])

    return docs.mapInArrow(run, "doc_id long, tag long, n_shingles long, set_key binary, bands binary")


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, cid): the classes of every bucket that holds at least two, with the bucket's size and centres."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["cid"].to_numpy(zero_copy_only=False)
            band = np.frombuffer(b"".join(batch["bands"].to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(band), pa.array(np.repeat(rows, BANDS))], names=["band", "cid"])

    every = classes.select("cid", "bands").mapInArrow(keys, "band long, cid long")
    # staged, so that both sides of the join come from plain shuffles, whose hot bands can be split
    shared = staged(every.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "minhash-shared")
    return every.join(shared, "band")


def _small_pairs(members: DataFrame) -> DataFrame:
    """(a, b, times): the pairs of classes that share small buckets, and how many they share."""
    small = members.where(F.col("size") <= SMALL).groupBy("band").agg(F.sort_array(F.collect_list("cid")).alias("cids"))
    pairs = small.select(F.explode(F.expr(
        "flatten(transform(cids, (x, i) -> transform(slice(cids, i + 2, size(cids)), y -> named_struct('a', x, 'b', y))))")).alias("p")).select("p.*")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("times"))


def _split_buckets(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(band, cid, size, component) of the large buckets whose classes lie in several components."""
    large = members.where(F.col("size") > SMALL)
    if labels is None:
        return large.withColumn("component", F.col("cid"))
    own = large.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    split = own.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("band")
    return own.join(split, "band").select("band", "cid", "size", "component")


def _star_pairs(members: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """(a, b): for each class of a split large bucket at most one pair, with the centre of one of its buckets."""
    own = staged(_split_buckets(members, labels), "minhash-split")
    centre = F.min(F.struct(F.xxhash64("cid", F.lit(turn)).alias("h"), F.col("cid").alias("c"), F.col("component").alias("of_c")))
    centres = staged(own.groupBy("band").agg(centre.alias("centre")).select("band", "centre.c", "centre.of_c"), "minhash-centres")
    # the largest bucket first, then others
    first = F.col("size") if turn == 0 else F.xxhash64("band", F.lit(turn))
    chosen = own.groupBy("cid", "component").agg(F.max(F.struct(first.alias("first"), "band")).alias("best")).select("cid", "component", "best.band")
    return (chosen.join(centres, "band").where("component != of_c")
            .select(F.least("cid", "c").alias("a"), F.greatest("cid", "c").alias("b")).distinct())


def _full_sets(docs: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """(cid, shingles): the whole sorted sets of the classes in ``needed``, from the documents that represent them."""
    wanted = classes.select("cid", "set_key", "doc_id", "tag").join(needed.select("cid").distinct(), "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for cid, key, found in zip(batch["cid"].to_pylist(), batch["set_key"].to_pylist(), sets_of(batch["text"]), strict=True):
                if len(found) and _set_key(found) == key:
                    ids.append(cid)
                    out.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["cid", "shingles"])

    return docs.join(wanted, ["doc_id", "tag"]).select("cid", "set_key", "text").mapInArrow(run, "cid long, shingles binary").dropDuplicates(["cid"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if PERCENT * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets confirm the link."""
    both = (pairs.select("a", "b").join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("of_a")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("of_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                    for x, y in zip(batch["of_a"].to_pylist(), batch["of_b"].to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components (a class without links is its own)."""
    a, b = (labels.select(F.col("node").alias(x), F.col("component").alias("of_" + x)) for x in ("a", "b"))
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select(*pairs.columns))


def _rest_links(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links among the classes of large buckets that lie in several components; None if there are none.

    Buckets that share a class form a cluster.  Its classes are dealt into
    blocks of about ``TILE_BYTES``, and a tile compares two blocks: every pair
    in different components once, by counting common shingles.
    """
    split = staged(_split_buckets(members, labels), "minhash-split")
    first = split.groupBy("band").agg(F.min("cid").alias("first"))
    rest = staged(split.join(first, "band").select("cid", "component", "first").distinct(), "minhash-rest")
    if rest.isEmpty():
        return None
    clusters = components(rest.where("cid != first").select(F.col("cid").alias("a"), F.col("first").alias("b")), "minhash-clusters")
    held = (rest.select("cid", "component").distinct().join(clusters.select(F.col("node").alias("cid"), F.col("component").alias("cluster")), "cid")
            .join(sets, "cid"))
    sizes = held.groupBy("cluster").agg(F.ceil(F.sum(F.octet_length("shingles")) / F.lit(TILE_BYTES)).alias("n_blocks"))
    dealt = held.join(sizes, "cluster").withColumn("block", F.expr("pmod(xxhash64(cid), n_blocks)"))
    tiles = dealt.select("cluster", "cid", "component", "shingles", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("other")) \
        .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "component", "shingles")

    def compare(tile: pa.Table) -> pa.Table:
        cids, comps, block = (tile[c].to_numpy() for c in ("cid", "component", "block"))
        sets_here = [np.frombuffer(x.as_py(), np.uint64) for x in tile["shingles"]]
        a, b = joining_links(cids, comps, block, sets_here, tile["i"][0].as_py() != tile["j"][0].as_py())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return tiles.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long")


def joining_links(cids: np.ndarray, comps: np.ndarray, block: np.ndarray, sets: list[np.ndarray], across: bool) -> tuple[list[int], list[int]]:
    """Links between classes of different components, at most one for each join; with ``across`` only those between two blocks."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    marked = np.zeros(int(numbers.max()) + 1, bool)
    label = comps.copy()
    a, b = [], []
    for i in range(len(sets)):
        own = numbers[starts[i]:starts[i + 1]]
        marked[own] = True
        common = np.add.reduceat(marked[numbers], starts[:-1], dtype=np.int64)
        marked[own] = False
        link = 100 * common >= PERCENT * (sizes[i] + sizes - common)
        if across:
            link &= block != block[i]
        for j in np.flatnonzero(link & (label != label[i])):
            if label[j] != label[i]:
                a.append(int(min(cids[i], cids[j])))
                b.append(int(max(cids[i], cids[j])))
                label[label == label[j]] = label[i]
    return a, b


def _linked_classes(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(node, component) of the classes that have links; None if no class has a candidate."""
    members = staged(_buckets(classes), "minhash-members")
    if members.isEmpty():
        return None
    pairs = staged(_small_pairs(members), "minhash-pairs")
    sets = staged(_full_sets(docs, classes, members), "minhash-sets")
    best = pairs.select(F.col("b").alias("cid"), F.struct(-F.col("times"), "a", "b").alias("p")).groupBy("cid").agg(F.min("p").alias("p")).select("p.a", "p.b")
    links = staged(_verified(best.unionByName(_star_pairs(members, None, 0)).distinct(), sets), "minhash-links")
    labels = components(links, "minhash-first")
    for turn in range(1, ROUNDS + 1):
        more = _star_pairs(members, labels, turn)
        if turn == 1:
            more = more.unionByName(_apart(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"), labels)).distinct()
        found = staged(_verified(more, sets), "minhash-links")
        links = links.unionByName(found)
        labels = components(links, "minhash-more")
    rest = _rest_links(members, labels, sets)
    return labels if rest is None else components(links.unionByName(rest), "minhash-last")


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tag, n_shingles, set_key, component_id, kept, group) of every row; tag is a hash of the text, group a number of the group."""
    importable(docs.sparkSession)
    own = docs.select(as_column(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("tag", F.xxhash64("text"))
    rows = staged(sketched(own), "minhash-rows")
    classes = staged(rows.where("set_key is not null and doc_id is not null").groupBy("set_key")
                     .agg(F.min(F.struct("doc_id", "tag")).alias("least"), F.first("bands").alias("bands"))
                     .select("set_key", "least.doc_id", "least.tag", "bands", F.monotonically_increasing_id().alias("cid")), "minhash-classes")
    labels = _linked_classes(own, classes)
    named = classes.select("set_key", "cid", "doc_id")
    if labels is None:
        named = named.select("set_key", F.col("cid").alias("group"), F.col("doc_id").alias("low"))
    else:
        named = staged(named.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
                       .select("set_key", F.coalesce("component", "cid").alias("group"), "doc_id"), "minhash-named")
        named = named.join(named.groupBy("group").agg(F.min("doc_id").alias("low")), "group").drop("doc_id")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("low"))
    return (rows.drop("bands").join(named, "set_key", "left").withColumn("component_id", component)
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
            .select("doc_id", "tag", "n_shingles", "set_key", "component_id", "kept", "group"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return _judged(docs, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, and every text without words; all columns kept.

    A group keeps the row of its smallest doc_id; of several of its rows with that
    id the one with the smallest text hash stays, once.  A group of rows without
    doc_id keeps one in the same way.
    """
    judged = _judged(docs, id_col, text_col).where("kept")
    groups = judged.groupBy("doc_id", "group", F.when(F.col("group").isNull(), F.col("set_key")).alias("set_key"),
                            F.when(F.col("set_key").isNull(), F.col("tag")).alias("empty")).agg(F.min("tag").alias("tag"))
    doc, tag, own = free_names(docs, "kept_doc", "kept_tag", "own_tag")
    stay = groups.select(F.col("doc_id").alias(doc), F.col("tag").alias(tag)).distinct()
    tagged = docs.withColumn(own, F.xxhash64(text_or_empty(text_col)))
    found = tagged.join(stay, as_column(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(tag)), "left_semi")
    return found.dropDuplicates([id_col, own]).select(*[as_column(c) for c in docs.columns])

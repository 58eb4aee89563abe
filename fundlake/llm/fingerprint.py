"""Document fingerprints: the k smallest hashes of a text's distinct five-word shingles.

Sketches of parts merge into the sketch of the whole (union, then the k
smallest).  From two sketches follow the resemblance and containment of the
shingle sets, from one the number of distinct shingles.  Words are as in
``shingles``: runs without ASCII white space, A-Z lower-cased.

Defined cases: a null text counts as empty; an empty text has the empty
fingerprint, alike (1.0) to another empty one and unlike (0.0) any other;
rows without doc_id come last in the order of documents, rows that share one
are ordered by a hash of their text and spread over tasks by it; a table's only document is its own next
one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, as_column, importable, text_or_empty
from .shingles import shingle_sets

K = 128
_LAST = 2**63 - 1
#: Number of the hashes that order the rows of one id.
_HASHES = 2**53


def sketches(texts: Sequence[str], k: int = K) -> list[np.ndarray]:
    """The bottom-k sketch of each text."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded], dtype=np.int64)])
    return [s[:k] for s in shingle_sets(np.frombuffer(b"".join(coded), np.uint8), offsets)]


def merge(parts: Sequence[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of the union of the parts' shingle sets."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *parts]))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated size of the intersection over that of the union (exact below k shingles)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge([a, b], k)
    return float(len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)) / len(union))


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too: of a's hashes in the range that both sketches cover whole."""
    covered = min((int(x[-1]) for x in (a, b) if len(x) >= k), default=2**64 - 1)
    own = a[a <= np.uint64(covered)]
    return float(np.isin(own, b, assume_unique=True).mean()) if len(own) else 1.0


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, n_shingles_est, fingerprint) of every text; row by row, nothing is shuffled."""
    importable(docs.sparkSession)
    own = docs.select(as_column(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for part in _parts(batch["text"].to_pylist()) for s in sketches(part, k)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([distinct_count(s, k) for s in found], pa.float64()), pa.array(map(to_text, found), pa.string())],
                names=["doc_id", "n_shingles_est", "fingerprint"])

    return own.mapInArrow(sketch, f"doc_id {dict(own.dtypes)['doc_id']}, n_shingles_est double, fingerprint string")


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of bounded length."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > BLOCK_BYTES:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def _place(place, hash_) -> str:
    return f"named_struct('place', {place}, 'hash', {hash_})"


def _long(x: int) -> str:
    return f"{x}L" if x > -2**63 else "(-9223372036854775807L - 1L)"


def _part(bounds: list[tuple[int, int]]) -> tuple[str, str]:
    """(SQL array of the bounds, SQL of a row's part): by binary search, the last bound that is not above the row's place."""
    listed = "array(" + ", ".join(_place(_long(b), _long(h)) for b, h in bounds) + ")"
    steps = "array(" + ", ".join(str(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1)) + ")"
    return listed, (f"aggregate({steps}, 0, (low, step) -> if(low + step < {len(bounds)} and get({listed}, low + step) <= "
                    f"{_place('place', 'hash')}, low + step, low))")


def _bounds(docs: DataFrame, parts: int) -> list[tuple[int, int]]:
    """About ``parts`` places (id, hash of the text) of rows of ``docs``, ascending, the first row's among them.

    Quantiles of the ids cut the table; an id that comes out several times holds
    that many parts' rows, which equal ranges of the hash cut.  The bounds are the
    first places in those ranges.  At most about 2 * ``parts`` rows are collected.
    """
    found = docs.agg(F.percentile_approx("place", [i / parts for i in range(parts)], 10000).alias("ids")).first()["ids"]
    times = Counter(found or [])
    cuts = sorted({(-2**63, 0), *((i, k * _HASHES // n) for i, n in times.items() for k in range(n))})
    # one number for both, so that the least is found by a hash aggregate
    both = f"CAST(place AS DECIMAL(20, 0)) * {_HASHES} + hash"
    firsts = docs.groupBy(F.expr(_part(cuts)[1]).alias("part")).agg(F.min(F.expr(both)).alias("first")).collect()
    return sorted(divmod(int(r["first"]), _HASHES) for r in firsts)


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """(guest, doc_id, text): documents in ascending order within range partitions, each followed by the next partition's first one.

    Places are (doc_id, hash of the text), so rows of one id, or without one,
    spread as well; only equal rows stay together.  The ranges begin at places
    that the table holds, so a partition's first row is known from its bound: it is
    sent twice, as itself and as a guest of the partition before (the first of
    equal guests counts).  The texts are shuffled once.
    """
    own = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("place"), F.shiftrightunsigned(F.xxhash64("text"), 11).alias("hash"))
    bounds = _bounds(own, parts) or [(_LAST, 0)]
    listed, part = _part(bounds)
    one = F.struct(F.col("at").alias("part"), F.lit(False).alias("guest"))
    before = F.struct(F.expr(f"pmod(at - 1, {len(bounds)})").alias("part"), F.lit(True).alias("guest"))
    begins = F.expr(f"get({listed}, at) = {_place('place', 'hash')}")
    placed = (own.withColumn("at", F.expr(part)).withColumn("to", F.explode(F.when(begins, F.array(one, before)).otherwise(F.array(one))))
              .select("doc_id", "text", "place", "hash", "to.part", "to.guest"))
    return (placed.repartitionById(len(bounds), F.col("part"))
            .sortWithinPartitions("guest", "place", "hash", "text").select("guest", "doc_id", "text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, parts: int | None = None) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and its likeness to the next document's.

    The edited text has the last quarter (by code points, rounded down)
    replaced by as many from the beginning of the next document.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    importable(docs.sparkSession)
    own = docs.select(as_column(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the document that waits for its next one
        for batch in batches:
            rows = list(zip(batch["guest"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True))
            guests = [r[0] for r in rows]
            if True in guests:
                rows = rows[:guests.index(True) + 1] if last is None or not last[0] else []
            for part in _parts([r[2] for r in rows]):
                group, rows = rows[:len(part)], rows[len(part):]
                chain = ([last] if last is not None else []) + [(*r, s) for r, s in zip(group, sketches(part, k), strict=True)]
                last = chain[-1]
                pairs = list(zip(chain, chain[1:], strict=False))
                edited = []
                for (_, _, text, _), (_, _, following, _) in pairs:
                    n = len(text) // 4
                    edited.append(text[:len(text) - n] + following[:n])
                out: dict[str, list] = {n: [] for n in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
                for ((_, doc, text, own_sketch), (_, _, _, next_sketch)), new, sketch in zip(pairs, edited, _sketched(edited, k), strict=True):
                    for name, value in zip(out, (doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own_sketch),
                                                 to_text(sketch), resemblance(own_sketch, sketch, k), resemblance(own_sketch, next_sketch, k)), strict=True):
                        out[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_chars"], pa.int64()), *(pa.array(out[n], pa.string()) for n in list(out)[2:5]),
                     *(pa.array(out[n], pa.float64()) for n in list(out)[5:])], names=list(out))

    return in_order(own, parts).mapInArrow(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _sketched(texts: list[str], k: int) -> list[np.ndarray]:
    return [s for part in _parts(texts) for s in sketches(part, k)]

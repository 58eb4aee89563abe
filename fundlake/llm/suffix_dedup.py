"""Exact substring dedup: every byte covered by a string of ``length`` bytes that starts anywhere else goes.

The suffixes of a whole corpus need not be sorted in one place.  A text's
windows of ``length`` bytes each choose an anchor, the window's 16 bytes of
smallest hash (the leftmost of equals); equal windows choose the same bytes at
the same place, so only windows with the same anchor bytes can be equal.  The
windows of one anchor form a segment.  Segments whose anchor bytes occur once
are done.  Of the others, equal ones collapse into one with a count, and the
different segments of the same anchors are joined into texts of bounded size.
There a two-stage suffix array and its neighbours' common prefixes tell which
windows occur again; equal windows are neighbours.  Anchors with more distinct
segments than a task should hold (the edges of a passage that very many
documents share) are taken apart by whole windows instead, counted map-side.

Defined cases: a null text counts as empty; texts under ``length`` bytes lose
nothing; matches never cross documents, overlapping ones and those within one
document count; every row is a document, so repeated rows remove each other's
long strings; rows that share a doc_id are told apart by their text; an empty
table gives an empty result.  Texts are bytes of UTF-8 and kept bytes may cut a
character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_column, blocks, importable, staged, text_or_empty, utf8_buffers
from .shingles import mix
from .suffix_array import common_prefixes, suffix_array, words

LENGTH = 200
GRAM = 16
#: Segment bytes that one suffix array takes, and those of one anchor above which it goes by whole windows.
ARRAY_BYTES = 1 << 20
ANCHOR_BYTES = 8 << 20
#: Window starts of a very long text handled at once.
SLICE = 4 << 20

_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes from each place on."""
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = (x[:-width] << np.uint64(8 * width)) | x[width:]
    return mix(x[:-8] * np.uint64(0x9E3779B97F4A7C15) + mix(x[8:]))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[:len(out) - (width - done)], out[width - done:]) if done < width else out


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor hash) of the runs of windows with a common anchor; places count within ``data``."""
    found = []
    lasts = offsets[1:] - length  # the last window of each text
    for a in range(0, len(data) - length + 1, SLICE):
        part = data[a:a + SLICE + length - 1]
        grams = gram_hashes(part)
        anchor = sliding_minimum((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1) & _PLACE
        n = len(anchor)
        edge = np.zeros(n + 1, np.int32)
        whole = lasts >= offsets[:-1]
        begin, end = np.clip(offsets[:-1][whole] - a, 0, n), np.clip(lasts[whole] + 1 - a, 0, n)
        np.add.at(edge, begin, 1)
        np.add.at(edge, end, -1)
        valid = np.cumsum(edge[:-1]) > 0
        fresh = np.empty(n, bool)
        fresh[0] = True
        fresh[1:] = anchor[1:] != anchor[:-1]
        fresh[begin[begin < n]] = True
        start = np.flatnonzero(fresh & valid)
        text = np.searchsorted(offsets, start + a, side="right") - 1
        stop = np.minimum(np.append(start[1:], n), lasts[text] + 1 - a)
        found.append((text, start + a, stop - start, grams[anchor[start]]))
    if not found:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, tag, start, windows, anchor, content): the segments of every text; content is a hash of the segment's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffers(batch["text"])
            for a, b in blocks(offsets):
                own, base = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                text, start, windows, anchor = segments(own, base, length)
                view = memoryview(own)
                content = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(start.tolist(), (start + windows + length - 1).tolist(), strict=True)),
                                      np.uint64, len(start))
                row = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(row), batch["tag"].take(row), pa.array((start - base[text]).astype(np.int32)), pa.array(windows.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))], names=["doc_id", "tag", "start", "windows", "anchor", "content"])

    return docs.mapInArrow(run, "doc_id long, tag long, start int, windows int, anchor long, content long")


def _once(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each (doc_id, tag); only the texts of repeated ones move."""
    repeated = staged(docs.groupBy("doc_id", "tag").count().where("count > 1").select(F.col("doc_id").alias("r_id"), F.col("tag").alias("r_tag")), "suffix-repeated")
    if repeated.isEmpty():
        return docs
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("tag") == F.col("r_tag"))
    return docs.join(repeated, same, "left_anti").unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "tag"]))


def _texts(docs: DataFrame, shared: DataFrame, length: int) -> DataFrame:
    """(anchor, content, n, windows, segment): the distinct segments with their bytes and how often they occur."""
    one = shared.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "tag", "start", "windows")).alias("at"))
    wanted = one.groupBy("at.doc_id", "at.tag").agg(F.collect_list(F.struct("at.start", "at.windows", "anchor", "content", "n")).alias("parts"))
    there = _once(docs).join(wanted.withColumnRenamed("doc_id", "of").withColumnRenamed("tag", "with"), (F.col("doc_id").eqNullSafe(F.col("of"))) & (F.col("tag") == F.col("with")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffers(batch["text"])
            view = memoryview(data)
            parts = batch["parts"]
            counts = np.diff(np.asarray(parts.offsets))
            flat = parts.flatten()
            start, windows = (flat.field(k).to_numpy() for k in ("start", "windows"))
            begin = np.repeat(offsets[:-1], counts) + start
            cut = [bytes(view[s:e]) for s, e in zip(begin.tolist(), (begin + windows + length - 1).tolist(), strict=True)]
            for a in range(0, len(cut), 4096):
                b = slice(a, a + 4096)
                yield pa.RecordBatch.from_arrays([*(flat.field(k)[b] for k in ("anchor", "content", "n", "windows")), pa.array(cut[b], pa.binary())],
                                                 names=["anchor", "content", "n", "windows", "segment"])

    return there.select("text", "parts").mapInArrow(run, "anchor long, content long, n long, windows int, segment binary")


def repeated_windows(parts: list[bytes], windows: np.ndarray, counts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window of the parts, one part after another, whether it occurs again (in another place of the parts, or by a part's count)."""
    sizes = np.array([len(p) + 1 for p in parts])
    begins = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.uint16) + 1
    symbols[begins + sizes - 1] = 0
    word = words(symbols)
    offset = np.cumsum(windows) - windows
    place = np.repeat(begins - offset, windows) + np.arange(int(windows.sum()))
    owned = np.full(len(symbols), -1)
    owned[place] = np.arange(len(place))
    order = suffix_array(symbols, word, length, owned >= 0)
    order = order[owned[order] >= 0]
    again = common_prefixes(word, order, length) >= length
    out = np.repeat(counts > 1, windows)
    out[owned[order[1:][again]]] = True
    out[owned[order[:-1][again]]] = True
    return out


def _spans(again: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(part, [from, to, ...] in bytes of it) for each part with a repeated window."""
    part = np.repeat(np.arange(len(windows)), windows)
    within = np.arange(len(again)) - np.repeat(np.cumsum(windows) - windows, windows)
    begins = again & ~np.where(within > 0, np.concatenate([[False], again[:-1]]), False)
    last = np.append(within[1:] == 0, True)
    ends = again & (last | ~np.append(again[1:], False))
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    pairs = np.stack([within[a], within[b] + length], axis=1).astype(np.int32)
    owner, first = np.unique(part[a], return_index=True)
    return owner, [p.ravel() for p in np.split(pairs, first[1:])] if len(owner) else []


def _by_array(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, content, spans) from suffix arrays over whole anchors, about ARRAY_BYTES at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            windows, counts = np.array([r[3] for r in held], np.int64), np.array([r[2] for r in held])
            owner, spans = _spans(repeated_windows([r[4] for r in held], windows, counts, length), windows, length)
            return pa.RecordBatch.from_arrays([pa.array([held[i][0] for i in owner], pa.int64()), pa.array([held[i][1] for i in owner], pa.int64()),
                                               pa.array(spans, pa.list_(pa.int32()))], names=["anchor", "content", "spans"])

        for batch in batches:
            for row in zip(*(batch[k].to_pylist() for k in ("anchor", "content", "n", "windows", "segment")), strict=True):
                if size >= ARRAY_BYTES and held[-1][0] != row[0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield flush()

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.repartition(parts, "anchor").sortWithinPartitions("anchor").select("anchor", "content", "n", "windows", "segment") \
        .mapInArrow(run, "anchor long, content long, spans array<int>")


def _by_window(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, content, spans) for anchors with very many distinct segments: whole windows counted by a 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, n, windows, segment in zip(*(batch[k].to_pylist() for k in ("anchor", "content", "n", "windows", "segment")), strict=True):
                view = memoryview(segment)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * windows, pa.int64()), pa.array([content] * windows, pa.int64()), pa.array([n] * windows, pa.int64()),
                     pa.array(range(windows), pa.int32()), pa.array([xxhash.xxh3_128_digest(view[i:i + length]) for i in range(windows)], pa.binary())],
                    names=["anchor", "content", "n", "at", "window"])

    each = staged(texts.mapInArrow(run, "anchor long, content long, n long, at int, window binary"), "suffix-windows")
    again = each.groupBy("window").agg(F.sum("n").alias("times")).where("times > 1").select("window")
    return (each.join(again, "window").groupBy("anchor", "content")
            .agg(F.flatten(F.sort_array(F.collect_list(F.array("at", F.col("at") + length)))).alias("spans")))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, tag, spans): for each document [from, to, ...] of bytes in repeated strings, unmerged; ``docs`` has doc_id, tag and text."""
    every = staged(_anchored(docs, length), "suffix-segments")
    # staged, so that both sides of the join come from plain shuffles, whose hot anchors can be split
    twice = staged(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "suffix-twice")
    shared = staged(every.join(twice, "anchor"), "suffix-shared")
    texts = staged(_texts(docs, shared, length), "suffix-texts")
    sizes = texts.groupBy("anchor").agg(F.sum(F.octet_length("segment")).alias("bytes")).where(F.col("bytes") > ANCHOR_BYTES).select("anchor")
    large = staged(sizes, "suffix-large")
    if large.isEmpty():
        found = _by_array(texts, length)
    else:
        found = _by_array(texts.join(large, "anchor", "left_anti"), length).unionByName(_by_window(texts.join(large, "anchor"), length))
    moved = shared.join(found, ["anchor", "content"]).select("doc_id", "tag", F.expr("transform(spans, x -> x + start)").alias("spans"))
    # a set: rows that repeat doc_id and text have equal spans
    return moved.groupBy("doc_id", "tag").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans become one; [from, to, ...] in, in any order."""
    pairs = spans.reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    at = np.flatnonzero(first)
    return list(zip(pairs[at, 0].tolist(), reach[np.append(at[1:], len(pairs)) - 1].tolist(), strict=True))


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, last = [], 0
    for a, b in spans:
        kept.append(text[last:a])
        last = b
    return b"".join([*kept, text[last:]])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document, with the kept bytes and the removed spans if asked for."""
    importable(docs.sparkSession)
    own = docs.select(as_column(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("tag", F.xxhash64("text"))
    spans = repeated_spans(own, length).select(F.col("doc_id").alias("of"), F.col("tag").alias("with"), "spans")
    there = own.join(spans, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("tag") == F.col("with")), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, sums, kept, gone = [], [], [], [], [], []
            for text, found in zip(batch["text"], batch["spans"], strict=True):
                whole = text.as_buffer().to_pybytes() if text.is_valid else b""
                cut = merged(found.values.to_numpy()) if found.is_valid else []
                rest = without(whole, cut)
                sizes.append(len(whole))
                removed.append(len(whole) - len(rest))
                runs.append(len(cut))
                sums.append(hashlib.sha256(rest).hexdigest())
                if keep_text:
                    kept.append(rest)
                    gone.append([x for span in cut for x in span])
            columns = [batch["doc_id"], *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(sums, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns += [pa.array(kept, pa.binary()), pa.array(gone, pa.list_(pa.int32()))]
                names += ["kept", "removed"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return there.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary, removed array<int>" if keep_text else ""))

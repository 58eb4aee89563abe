"""Quality classifier: a convolutional network over a text's bytes, in numpy.

Bytes are embedded (a byte whose last four bytes stood a short way before has
an embedding of its own, so that repetition shows), a layer of learned filters runs over overlapping chunks
that cover the whole text, each filter's largest answer in a chunk is kept, and
the chunks' answers (their mean and their largest) combine into one
probability that the text is of label 1.

Fitting takes a bounded sample of labelled rows: at most ``SAMPLE_PER_LABEL``
documents of each label, those with the smallest hash of their id among the
rows that are not held out, without texts over ``MAX_FIT_BYTES``.  Short
stretches of the label-1 texts are learnt as label 1 too, so that a text is
not rejected for being short.  Scoring reads every text whole.  Only text bytes
go in.

Defined cases: a null text counts as empty; an empty text has no chunk and
gets the score that the network gives to silence; null labels are not learnt
from, an id with both labels is learnt as both; rows that repeat a labelled id count once; with fewer than two labels to learn from, every score is the share of
label 1 (0.5 without any); a null doc_id hashes as the empty string; repeated
rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_column, blocks, importable, staged, text_or_empty, utf8_buffers

SAMPLE_PER_LABEL = 1000
MAX_FIT_BYTES = 1 << 16
THRESHOLD = 0.7

#: Chunk length and step in bytes: neighbours overlap by more than a filter's width.
CHUNK, STEP = 512, 480
#: Embedding size, filter width in bytes, distance of the filters' places, number of filters.
DIM, WIDTH, STRIDE, FILTERS = 8, 8, 2, 24
#: Distances at which the last four bytes count as repeated.
LAGS = range(3, 33)
SYMBOLS = 513
_PAD = 512
_SLAB = 512


@dataclass(frozen=True)
class Network:
    embed: np.ndarray  # (SYMBOLS, DIM), the padding's row is 0
    filters: np.ndarray  # (WIDTH * DIM, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,): of the chunks' means, of their maxima
    offset: float

    @staticmethod
    def constant(share: float) -> Network:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Network(np.zeros((SYMBOLS, DIM), np.float32), np.zeros((WIDTH * DIM, FILTERS), np.float32), np.zeros(FILTERS, np.float32),
                       np.zeros(2 * FILTERS, np.float32), float(np.log(share / (1 - share))))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for testing: crc32 of its id as text, mod 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def symbols(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte's number, plus 256 if it and the three bytes before it stood 3 to 32 bytes earlier in its text too."""
    out = data.astype(np.int16)
    n = len(data)
    if n < 7:
        return out
    four = data.astype(np.uint32)
    four[3:] |= (four[2:-1] << np.uint32(8)) | (four[1:-2] << np.uint32(16)) | (four[:-3] << np.uint32(24))
    lengths = np.diff(offsets)
    within = np.arange(n, dtype=np.int32) - np.repeat(offsets[:-1], lengths).astype(np.int32)
    repeated = np.zeros(n, bool)
    for lag in LAGS:
        if lag < n:
            repeated[lag:] |= (four[lag:] == four[:-lag]) & (within[lag:] >= lag + 3)
    out[repeated] += 256
    return out


def layout(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin of each chunk, end of its text, first chunk of each text): every byte is in a chunk, every filter place too."""
    lengths = np.diff(offsets)
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - CHUNK) // STEP)), 0)
    first = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(lengths)), counts)
    return offsets[:-1][text] + (np.arange(first[-1]) - first[:-1][text]) * STEP, offsets[1:][text], first


def _symbols_at(marked: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Symbols at places, padding from ``end`` on."""
    return np.where(at < end, marked[np.minimum(at, len(marked) - 1)], np.int16(_PAD))


def _places(embedded: np.ndarray, phase: int) -> np.ndarray:
    """(chunks, places, WIDTH * DIM): windows that begin at phase, phase + WIDTH, ..."""
    n = (CHUNK - phase) // WIDTH
    return embedded[:, phase:phase + n * WIDTH].reshape(len(embedded), n, WIDTH * DIM)


def pooled(net: Network, marked: np.ndarray, begin: np.ndarray, end: np.ndarray,
           with_places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Each filter's largest answer in each chunk and, if asked for, where it is; a slab of chunks at a time."""
    best = np.full((len(begin), FILTERS), -np.inf, np.float32)
    where = np.zeros((len(begin), FILTERS), np.int64) if with_places else None
    for a in range(0, len(begin), _SLAB):
        slab = slice(a, a + _SLAB)
        embedded = net.embed[_symbols_at(marked, begin[slab, None] + np.arange(CHUNK), end[slab, None])]
        part = best[slab]
        for phase in range(0, WIDTH, STRIDE):
            answers = _places(embedded, phase) @ net.filters
            if where is None:
                np.maximum(part, answers.max(axis=1), out=part)
            else:
                at = answers.argmax(axis=1)
                top = np.take_along_axis(answers, at[:, None], 1)[:, 0]
                better = top > part
                where[slab][better] = (at * WIDTH + phase)[better]
                part[better] = top[better]
    return best, where


def _combine(net: Network, answers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, log-odds) of each text from its chunks' answers."""
    live = np.maximum(answers + net.bias, 0)
    counts = np.diff(first)
    full = counts > 0
    features = np.zeros((len(counts), 2 * FILTERS), np.float32)
    if full.any():
        starts = first[:-1][full]
        features[full, :FILTERS] = np.add.reduceat(live, starts) / counts[full, None]
        features[full, FILTERS:] = np.maximum.reduceat(live, starts)
    return features, features @ net.weights + net.offset


def probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    begin, end, first = layout(offsets)
    odds = _combine(net, pooled(net, symbols(data, offsets), begin, end)[0], first)[1].astype(float)
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def with_stretches(texts: list[bytes], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """The sample and a random short run of words of each label-1 text."""
    more = []
    for text in (t for t, label in zip(texts, labels, strict=True) if label == 1):
        words = text.split(b" ")
        n = int(rng.integers(2, 40))
        a = int(rng.integers(0, max(1, len(words) - n)))
        more.append(b" ".join(words[a:a + n]))
    return texts + more, np.concatenate([labels, np.ones(len(more))])


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the mean cross-entropy; gradients follow the pooled places only."""
    if len(set(labels.tolist())) < 2:
        return Network.constant(float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    texts, labels = with_stretches(texts, labels, rng)
    p = {"embed": rng.normal(0, 0.5, (SYMBOLS, DIM)), "filters": rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)),
         "bias": np.zeros(FILTERS), "weights": rng.normal(0, FILTERS ** -0.5, 2 * FILTERS), "offset": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["embed"][_PAD] = 0
    first_moment, second_moment, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            rows = order[a:a + batch]
            t += 1
            grads = _gradients(p, [texts[i] for i in rows], labels[rows])
            for k, g in grads.items():
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * g * g
                p[k] -= rate * (first_moment[k] / (1 - 0.9 ** t)) / (np.sqrt(second_moment[k] / (1 - 0.999 ** t)) + 1e-8)
            p["embed"][_PAD] = 0
    return Network(p["embed"], p["filters"], p["bias"], p["weights"], float(p["offset"][0]))


def _gradients(p: dict[str, np.ndarray], texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
    net = Network(p["embed"], p["filters"], p["bias"], p["weights"], float(p["offset"][0]))
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    marked = symbols(np.frombuffer(b"".join(texts), np.uint8), offsets)
    begin, end, first = layout(offsets)
    answers, where = pooled(net, marked, begin, end, with_places=True)
    features, odds = _combine(net, answers, first)
    error = ((1 / (1 + np.exp(-np.clip(odds, -60, 60)))) - labels).astype(np.float32) / len(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    live = np.maximum(answers + net.bias, 0)
    d_feature = error[:, None] * net.weights[None, :]
    d_live = d_feature[text, :FILTERS] / np.diff(first)[text, None]
    is_top = live == features[text, FILTERS:]
    d_live = (d_live + is_top * d_feature[text, FILTERS:]) * (live > 0)
    row, f = np.nonzero(d_live)
    d = d_live[row, f]
    d_filters, d_embed = np.zeros_like(p["filters"]), np.zeros_like(p["embed"])
    at = where[row, f]
    for k in range(WIDTH):
        byte = _symbols_at(marked, begin[row] + at + k, end[row])
        embedded = net.embed[byte] * d[:, None]
        part = slice(k * DIM, (k + 1) * DIM)
        down = net.filters[part][:, f].T * d[:, None]
        for j in range(DIM):
            d_filters[k * DIM + j] = np.bincount(f, embedded[:, j], FILTERS)
            d_embed[:, j] += np.bincount(byte, down[:, j], SYMBOLS)
    return {"embed": d_embed, "filters": d_filters, "bias": d_live.sum(axis=0), "weights": features.T @ error,
            "offset": np.array([error.sum()], np.float32)}


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, max_bytes: int = MAX_FIT_BYTES) -> Network:
    """A network from a bounded sample of the labelled documents that are not held out."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    # somewhat more ids than are taken: some have no document, or a text that is too long
    turn = F.xxhash64("doc_id")
    ids = [usable.where(F.col("quality") == q).distinct().orderBy(turn, "doc_id").limit(2 * per_label) for q in (0, 1)]
    chosen = staged(ids[0].unionByName(ids[1]).coalesce(1), "quality-sample")
    texts = docs.select("doc_id", text_or_empty().alias("text")).where(F.octet_length("text") <= max_bytes)
    # repeated rows of one id count once, by the least text; the cap comes before anything is collected
    once = staged(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")), "quality-texts")
    taken = [r for q in (0, 1) for r in once.where(F.col("quality") == q).orderBy(turn, "doc_id").limit(per_label).collect()]
    return train([r.text.encode("utf-8") for r in taken], np.array([r.quality for r in taken], float))


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    own = docs.select(as_column(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), held_out(as_column(id_col)).alias("held_out"))
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(_scores(shared.value, batch["text"]), pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    scored = own.mapInArrow(judge, f"doc_id {dict(own.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def _scores(net: Network, texts: pa.Array) -> np.ndarray:
    data, offsets = utf8_buffers(texts)
    parts = [probabilities(net, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in blocks(offsets, 1 << 20)]
    return np.round(np.concatenate([np.empty(0), *parts]), 6)


def keep_good(docs: DataFrame, net: Network, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``; all columns kept."""
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            yield batch.filter(pa.array(_scores(shared.value, texts) >= threshold))

    # plain names in between: a mapped DataFrame may not have dots in its column names
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)

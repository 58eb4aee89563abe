"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors.

1. Voters.  Each looks at a whole text and fires or not: fixed lexicons (nouns
   and adjectives of abuse, profanity, other languages), fixed patterns (abuse
   of the reader, threats, shouting), lexicons learnt from labelled rows (words,
   and beginnings of words, which catch inflected forms, and several different
   words of one beginning close together; each kind dealt to two voters) and a
   voter for several different hits.
2. Label model.  Votes are taken to be drawn from an unknown class: a prior, and
   for each voter the chance to fire given the class and one other voter.  Those
   parents form the spanning tree of largest conditional mutual information
   (the voters' correlations); the chances are their accuracies.  EM estimates
   all of it from how often each vote pattern occurs among all documents that
   are not held out (counted in Spark; at most ``2 ** len(VOTERS)`` patterns),
   anchored by the patterns of the labelled sample.
3. Classifier.  A logistic regression over those features and the
   votes, learnt on posterior labels; weights are not negative, so a long text
   cannot outweigh abuse, and features that a test does not part from
   chance are left out.

Fitting takes a bounded sample: at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``
labelled documents and ``SAMPLE_OTHER`` without a label, those with the smallest
hashes of their ids among the rows that are not held out, without texts over
``MAX_FIT_BYTES``.  Counting and scoring read every text whole.  Only text goes
into a score.

Defined cases: a null text counts as empty, and an empty one gets the score of
no evidence; null labels are not learnt from, nor ids with both labels; without
labels the fixed voters alone train the model, without documents every score is
0.5; a null doc_id hashes as the empty string; repeated rows give repeated
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_column, blocks, importable, staged, text_or_empty, utf8_buffers
from .minhash import sets_of
from .shingles import mix, seeds

SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_OTHER = 1500, 4500, 1500
MAX_FIT_BYTES = 1 << 15
THRESHOLD = 0.7

# Common words of abuse.
ABUSE_NOUNS = ("idiot idiots moron morons loser losers clown clowns scum trash garbage imbecile imbeciles fool fools jerk jerks dumbass "
               "bastard bastards creep creeps pig pigs coward cowards parasite parasites vermin lowlife scumbag scumbags").split()
ABUSE_ADJECTIVES = ("stupid pathetic worthless disgusting dumb idiotic moronic brainless useless ugly filthy vile despicable repulsive "
                    "contemptible braindead retarded").split()
PROFANITY = "shit shitty crap bullshit fuck fucking fucked fucker asshole assholes bitch bitches damn piss pissed".split()
OTHER_LANGUAGES = ("connard connards connasse salaud salope imbécile crétin abruti débile merde ordure minable dégoûtant "
                   "arschloch idioten dummkopf trottel scheiße scheisse abschaum widerlich wertlos vollidiot "
                   "idiota idiotas imbécil estúpido estúpida basura escoria patético inútil asqueroso gilipollas payaso").split()
PATTERNS = {
    "at_reader": r"\b(you|your|u|ur|tu|du|toi|eres|bist|es)\b[^.!?\n]{0,24}\b(" + "|".join(ABUSE_NOUNS + ABUSE_ADJECTIVES) + r")\b",
    "threat": r"\b(shut up|go to hell|drop dead|kill yourself|hate you|hope you die|get lost|screw you|deserve to die)\b",
    "shouting": r"(\b[A-Z]{3,}\b[ ,]+){3,}[A-Z]{3,}\s?!",
}
#: Beginnings of words that are looked at, in bytes, and the stretch of words in which several words of one beginning are a feature of their own.
PREFIXES = (4, 5, 6)
STRETCH = 128
VOTERS = ("nouns", "adjectives", "profanity", "other_languages", "at_reader", "threat", "shouting", "words_0", "words_1", "prefixes_0", "prefixes_1", "several")
_LEXICONS = (ABUSE_NOUNS, ABUSE_ADJECTIVES, PROFANITY, OTHER_LANGUAGES)
_WORDS, _PREFIX, _SEVERAL = 7, 9, 11
#: Likelihood ratio statistics that a feature of the classifier, and an entry of a learnt lexicon, must reach.
FEATURE_TEST, LEXICON_TEST = 16.0, 24.0
#: How many times likelier in a toxic text an entry of a learnt lexicon must be.
LEXICON_LIFT = 20.0

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_BYTE = seeds(256, 5000)
_KIND = seeds(1 + len(PREFIXES), 6000)
_DENSE = seeds(1, 6500)[0]
_BASE = int(seeds(1, 17)[0])


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for testing: crc32 of its id as text, mod 3, is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, kind, word) of every word and beginning of a word; kind 0 is the whole word.

    ``word`` is the place among all words, which come first and in order.
    ``data`` is lower-cased.
    """
    letter = _LETTER[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = letter[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int8), np.empty(0, np.int64)
    stops = ~letter
    stops[edges] = True
    ends = np.append(np.flatnonzero(stops), len(data))
    ends = ends[np.searchsorted(ends, starts, side="right")]
    lengths = ends - starts
    within = np.zeros(len(data), np.int64)
    within[starts[0]:] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    powers = np.multiply.accumulate(np.full(int(lengths.max()) + 1, _BASE, np.uint64))
    terms = _BYTE[data] * powers[np.minimum(within, len(powers) - 1)]
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    text = np.searchsorted(offsets, starts, side="right") - 1
    texts, hashes, kinds = [text], [mix((upto[ends] - upto[starts]) ^ _KIND[0])], [np.zeros(len(starts), np.int8)]
    words = [np.arange(len(starts))]
    for k, n in enumerate(PREFIXES, 1):
        long = np.flatnonzero(lengths >= n)
        texts.append(text[long])
        hashes.append(mix((upto[starts[long] + n] - upto[starts[long]]) ^ _KIND[k]))
        kinds.append(np.full(len(long), k, np.int8))
        words.append(long)
    return np.concatenate(texts), np.concatenate(hashes), np.concatenate(kinds), np.concatenate(words)


def dense(text: np.ndarray, key: np.ndarray, word: np.ndarray, word_hash: np.ndarray, first_word: np.ndarray) -> np.ndarray:
    """Rows (one each) of the (text, key) pairs that several different words bear within ``STRETCH`` words."""
    stretch = (word - first_word[text]) // STRETCH
    order = np.lexsort((word_hash, key, stretch, text))
    same = np.ones(max(len(order) - 1, 0), bool)
    for column in (text, stretch, key):
        same &= column[order][1:] == column[order][:-1]
    rows = order[1:][same & (word_hash[order][1:] != word_hash[order][:-1])]
    return rows[np.unique(np.stack([text[rows], key[rows].astype(np.uint64).view(np.int64)]), axis=1, return_index=True)[1]] if len(rows) else rows


def first_words(text: np.ndarray, kinds: np.ndarray, n: int) -> np.ndarray:
    """The first word of each of ``n`` texts."""
    return np.searchsorted(text[:np.count_nonzero(kinds == 0)], np.arange(n))


def word_hash(word: str) -> int:
    data = np.frombuffer(word.lower().encode(), np.uint8)
    return int(features(data, np.array([0, len(data)]))[1][0])


def present(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, number of texts, text, hash, kind, word): the features of whole texts, a block of them at a time."""
    data, offsets = utf8_buffers(pc.utf8_lower(texts.fill_null("")))
    for a, b in blocks(offsets):
        yield a, b - a, *features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


@dataclass(frozen=True)
class Table:
    """Hashes of interest, sorted; for each the voters it belongs to (bits), the classifier's column
    (-1: none) and the row of the feature that several of its words in a stretch make (-1: none)."""

    keys: np.ndarray
    voters: np.ndarray
    columns: np.ndarray
    several: np.ndarray

    def __post_init__(self) -> None:
        maybe = np.zeros(1 << 16, bool)
        maybe[(self.keys & np.uint64(0xFFFF)).astype(np.intp)] = True
        object.__setattr__(self, "_maybe", maybe)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``hashes``, rows of this table) of those that are in it."""
        at = np.flatnonzero(self._maybe[(hashes & np.uint64(0xFFFF)).astype(np.intp)])
        if not len(self.keys) or not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        row = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[row] == hashes[at]
        return at[hit], row[hit]


def votes(table: Table, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(votes as bits of each text, its features of the classifier as (text, column) pairs)."""
    texts = texts.fill_null("")
    bits = np.zeros(len(texts), np.int64)
    pairs = []
    for first, n, text, hashes, kinds, word in present(texts):
        at, row = table.find(hashes)
        text_of, word_of = text[at], word[at]
        part = np.flatnonzero(table.several[row] >= 0)
        part = part[dense(text_of[part], row[part], word_of[part], hashes[word_of[part]], first_words(text, kinds, n))] if len(part) else part
        at, row = np.append(at, at[part]), np.append(row, table.several[row[part]])
        own = np.unique(text[at] * len(table.keys) + row)
        text_of, row = own // max(len(table.keys), 1), own % max(len(table.keys), 1)
        np.bitwise_or.at(bits, first + text_of, table.voters[row])
        several = np.bincount(text_of[table.voters[row] > 0], minlength=n) >= 2
        bits[first:first + n] |= several.astype(np.int64) << _SEVERAL
        used = table.columns[row] >= 0
        pairs.append((first + text_of[used], table.columns[row[used]]))
    lower = pc.utf8_lower(texts)
    for name, pattern in PATTERNS.items():
        fires = pc.match_substring_regex(texts if name == "shouting" else lower, pattern)
        bits |= fires.to_numpy(zero_copy_only=False).astype(np.int64) << VOTERS.index(name)
    return bits, pairs


def likelihood_ratio(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """G statistic of a feature in ``a`` of n_a and ``b`` of n_b texts against equal shares."""
    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0.0)

    share = (a + b) / max(n_a + n_b, 1)
    return 2 * (part(a, n_a * share) + part(b, n_b * share) + part(n_a - a, n_a * (1 - share)) + part(n_b - b, n_b * (1 - share)))


def first_of_copies(texts: list[str], held: int = 8) -> np.ndarray:
    """Which texts are not near copies of an earlier one: fewer than half of the ``held`` least shingle hashes in common.

    A family of copies would make each of its words look like a sign of its label.
    """
    seen: dict[int, list[int]] = {}
    once = np.ones(len(texts), bool)
    for i, found in enumerate(sets_of(pa.array(texts, pa.string()))):
        least = found[:held].tolist()
        common: dict[int, int] = {}
        for h in least:
            for j in seen.get(h, ()):
                common[j] = common.get(j, 0) + 1
        once[i] = 2 * max(common.values(), default=0) < len(least) or not least
        if once[i]:
            for h in least:
                seen.setdefault(h, []).append(i)
    return once


def build_table(texts: list[str], labels: np.ndarray) -> tuple[Table, int]:
    """(table of fixed and learnt entries, number of the classifier's columns) from labelled texts, near copies counted once."""
    once = first_of_copies(texts)
    texts, labels = [t for t, o in zip(texts, once, strict=True) if o], labels[once]
    doc, key, kind, base = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int8)], [np.empty((2, 0), np.uint64)]
    for first, n, text, hashes, kinds, word in present(pa.array(texts, pa.string())):
        parts = np.flatnonzero(kinds > 0)
        parts = parts[dense(text[parts], hashes[parts], word[parts], hashes[word[parts]], first_words(text, kinds, n))]
        text, kinds = np.append(text, text[parts]), np.append(kinds, np.full(len(parts), 1 + len(PREFIXES), np.int8))
        base.append(np.stack([hashes[parts], mix(hashes[parts] ^ _DENSE)]))
        hashes = np.append(hashes, base[-1][1])
        order = np.lexsort((hashes, text))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
        doc.append(first + text[order][new])
        key.append(hashes[order][new])
        kind.append(kinds[order][new])
    doc, key, kind = np.concatenate(doc), np.concatenate(key), np.concatenate(kind)
    keys, where, at = np.unique(key, return_index=True, return_inverse=True)
    kinds = kind[where]
    a = np.bincount(at, labels[doc], len(keys))
    b = np.bincount(at, 1 - labels[doc], len(keys))
    n_a, n_b = int(labels.sum()), int((1 - labels).sum())
    test = likelihood_ratio(a, b, n_a, n_b)
    lift = ((a + 0.5) / (n_a + 1)) / ((b + 0.5) / (n_b + 1))
    useful = (test >= FEATURE_TEST) & (lift > 1)
    strong = (test >= LEXICON_TEST) & (lift >= LEXICON_LIFT)
    entries: dict[int, int] = {}
    for i, words in enumerate(_LEXICONS):
        for word in words:
            entries[word_hash(word)] = entries.get(word_hash(word), 0) | 1 << i
    for k, is_prefix in zip(keys[strong].tolist(), (kinds[strong] > 0).tolist(), strict=True):
        entries[k] = entries.get(k, 0) | 1 << ((_PREFIX if is_prefix else _WORDS) + (k >> 60) % 2)
    chosen = np.unique(np.concatenate([np.array(sorted(entries), np.uint64), keys[useful]]))
    pairs = np.concatenate(base, axis=1)
    pairs = np.unique(pairs[:, np.isin(pairs[1], chosen)], axis=1)
    every = np.union1d(chosen, pairs[0])
    voters = np.array([entries.get(k, 0) for k in every.tolist()], np.int64)
    columns = np.full(len(every), -1, np.int64)
    own = np.isin(every, keys[useful])
    columns[own] = np.arange(own.sum())
    several = np.full(len(every), -1, np.int64)
    several[np.searchsorted(every, pairs[0])] = np.searchsorted(every, pairs[1])
    return Table(every, voters, columns, several), int(own.sum())


def vote_matrix(patterns: np.ndarray) -> np.ndarray:
    return (np.asarray(patterns, np.int64)[:, None] >> np.arange(len(VOTERS))) & 1


@dataclass(frozen=True)
class LabelModel:
    """P(class), and for each voter the voter it depends on (-1: none) and P(fires | class, that voter's vote)."""

    prior: float
    parent: np.ndarray  # (voters,)
    fires: np.ndarray  # (2, voters, 2)

    def posterior(self, matrix: np.ndarray) -> np.ndarray:
        """P(class 1) of rows of votes."""
        given = np.where(self.parent[None, :] >= 0, matrix[:, np.maximum(self.parent, 0)], 0)
        log = np.empty((2, len(matrix)))
        for y, share in enumerate((1 - self.prior, self.prior)):
            chance = self.fires[y][np.arange(len(self.parent))[None, :], given]
            log[y] = np.log(share) + np.log(np.where(matrix == 1, chance, 1 - chance)).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))


def dependency_tree(matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each voter's parent in the spanning tree of largest mutual information given the class; ``weights`` are (2, rows)."""
    m = matrix.shape[1]
    total = weights.sum()
    gain = np.zeros((m, m))
    for w in weights:
        mass = w.sum()
        if mass <= 0:
            continue
        one = w @ matrix
        both = matrix.T @ (w[:, None] * matrix)
        joint = np.stack([mass - one[:, None] - one[None, :] + both, one[None, :] - both, one[:, None] - both, both]) + 0.25
        joint /= joint.sum(axis=0)
        left, right = joint[2] + joint[3], joint[1] + joint[3]
        for k, (x, y) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
            gain += mass / total * joint[k] * np.log(joint[k] / ((left if x else 1 - left) * (right if y else 1 - right)))
    parent = np.full(m, -1)
    inside, best, link = np.zeros(m, bool), np.full(m, -np.inf), np.zeros(m, np.int64)
    best[0] = 0
    for turn in range(m):
        v = int(np.where(inside, -np.inf, best).argmax())
        inside[v] = True
        parent[v] = link[v] if turn else -1
        closer = ~inside & (gain[v] > best)
        best[closer], link[closer] = gain[v][closer], v
    return parent


def fit_label_model(matrix: np.ndarray, counts: np.ndarray, clean: np.ndarray, toxic: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM over vote patterns: ``counts`` of unlabelled texts, ``clean`` and ``toxic`` ones of the labelled anchors.

    Unlabelled counts weigh at most as much as the labelled ones together, so
    that the classes stay those of the labels.
    """
    known = clean.sum() + toxic.sum()
    scale = min(1.0, known / counts.sum()) if known and counts.sum() else 1.0
    q = np.where(matrix.any(axis=1), 0.9, 0.05)
    if clean.sum() and toxic.sum():
        chance = [(c @ matrix + 1) / (c.sum() + 2) for c in (clean, toxic)]
        share = toxic.sum() / known
        log = [np.log(p) + (np.log(np.where(matrix == 1, c, 1 - c))).sum(axis=1) for p, c in zip((1 - share, share), chance, strict=True)]
        q = 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))
    model = None
    for turn in range(rounds):
        weights = np.stack([clean + scale * counts * (1 - q), toxic + scale * counts * q])
        parent = dependency_tree(matrix, weights) if turn < 5 else model.parent
        given = np.where(parent[None, :] >= 0, matrix[:, np.maximum(parent, 0)], 0)
        fires = np.empty((2, matrix.shape[1], 2))
        for y in (0, 1):
            for v in (0, 1):
                mass = weights[y] @ (given == v)
                fires[y, :, v] = (weights[y] @ ((given == v) & (matrix == 1)) + (0.5 if y else 0.05)) / (mass + 1)
        prior = float(np.clip((weights[1].sum() + 1) / (weights.sum() + 2), 1e-6, 1 - 1e-6))
        model = LabelModel(prior, parent, fires)
        before, q = q, model.posterior(matrix)
        if turn >= 5 and np.abs(q - before).max(initial=0) < 1e-6:
            break
    return model


@dataclass(frozen=True)
class Classifier:
    table: Table
    weights: np.ndarray  # the table's columns, then the voters
    offset: float


def train(pairs: tuple[np.ndarray, np.ndarray], matrix: np.ndarray, n_columns: int, target: np.ndarray,
          rounds: int = 400, rate: float = 0.1, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, offset) of a logistic regression with weights of at least 0, by Adam over all rows."""
    vote_row, vote_column = np.nonzero(matrix)
    row, column = np.concatenate([pairs[0], vote_row]), np.concatenate([pairs[1], n_columns + vote_column])
    n, m = len(target), n_columns + matrix.shape[1]
    share = np.clip(target.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    theta = np.zeros(m + 1)
    theta[m] = np.log(share / (1 - share))
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, rounds + 1 if n else 1):
        odds = np.bincount(row, theta[column], n) + theta[m]
        error = 1 / (1 + np.exp(-np.clip(odds, -60, 60))) - target
        gradient = np.append(np.bincount(column, error[row], m) / n + penalty * theta[:m], error.mean())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
        theta -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
        theta[:m] = np.maximum(theta[:m], 0)
    return theta[:m], float(theta[m])


def _sample(docs: DataFrame, labels: DataFrame) -> list:
    """(text, toxic) rows of the bounded sample, toxic -1 without a label; bounded before anything is collected."""
    turn = F.xxhash64("doc_id")
    known = labels.select(as_column("doc_id").cast("long").alias("doc_id"), as_column("toxic").cast("int").alias("toxic"))
    known = (known.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
             .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high")).where("toxic = high").drop("high"))
    own = docs.select(as_column("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where(F.col("doc_id").isNotNull())
    other = own.where(~held_out(F.col("doc_id"))).select("doc_id", F.lit(-1).alias("toxic"))
    # twice the ids: some have no document, or a text that is too long
    sizes = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN, -1: SAMPLE_OTHER}
    first = [(other if y < 0 else known.where(F.col("toxic") == y)).orderBy(turn, "doc_id").limit(2 * n) for y, n in sizes.items()]
    ids = staged(first[0].unionByName(first[1]).unionByName(first[2]).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).coalesce(1), "toxicity-ids")
    # repeated rows of one id count once, by the least text
    texts = staged(own.where(F.octet_length("text") <= MAX_FIT_BYTES).join(F.broadcast(ids), "doc_id")
                   .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample")
    out = []
    for y, n in sizes.items():
        out += texts.where(F.col("toxic") == y).orderBy(turn, "doc_id").limit(n).select("text", "toxic").collect()
    return out


def _pattern_counts(docs: DataFrame, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, counts) over all documents that are not held out: at most 2 ** len(VOTERS) rows."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns, counts = np.unique(votes(shared.value, batch["text"])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.int64()), pa.array(counts, pa.int64())], names=["pattern", "n"])

    own = docs.where(~held_out(as_column("doc_id"))).select(text_or_empty().alias("text"))
    rows = own.mapInArrow(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    return np.array([r.pattern for r in rows], np.int64), np.array([r.n for r in rows], float)


#: How far a given label is trusted beside the voters.
LABEL_ACCURACY = 0.98


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier from the documents and labels that are not held out."""
    return fit_with_model(docs, labels)[0]


def fit_with_model(docs: DataFrame, labels: DataFrame) -> tuple[Classifier, LabelModel]:
    importable(docs.sparkSession)
    rows = _sample(docs, labels)
    texts, given = [r.text for r in rows], np.array([r.toxic for r in rows], np.int64)
    known = given >= 0
    table, n_columns = build_table([t for t, k in zip(texts, known, strict=True) if k], given[known].astype(float))
    patterns, counts = _pattern_counts(docs, table)
    bits, pairs = votes(table, pa.array(texts, pa.string()))
    every = np.unique(np.concatenate([patterns, bits, [0]]))
    at = np.searchsorted(every, bits)
    clean, toxic = (np.bincount(at[given == y], minlength=len(every)).astype(float) for y in (0, 1))
    total = np.zeros(len(every))
    total[np.searchsorted(every, patterns)] = counts
    model = fit_label_model(vote_matrix(every), total, clean, toxic)
    # a given label is one more vote, of known accuracy
    trust = np.where(given == 1, LABEL_ACCURACY / (1 - LABEL_ACCURACY), np.where(given == 0, (1 - LABEL_ACCURACY) / LABEL_ACCURACY, 1.0))
    q = model.posterior(vote_matrix(bits))
    target = q * trust / (q * trust + 1 - q)
    merged = tuple(np.concatenate([np.empty(0, np.int64), *[p[i] for p in pairs]]) for i in (0, 1))
    weights, offset = train(merged, vote_matrix(bits), n_columns, target) if len(rows) else (np.zeros(n_columns + len(VOTERS)), 0.0)
    return Classifier(table, weights, offset), model


def scores(net: Classifier, texts: pa.Array) -> np.ndarray:
    bits, pairs = votes(net.table, texts)
    odds = net.offset + vote_matrix(bits) @ net.weights[len(net.weights) - len(VOTERS):]
    for text, column in pairs:
        odds += np.bincount(text, net.weights[column], len(odds))
    return np.round(1 / (1 + np.exp(-np.clip(odds, -60, 60))), 6)


def score(docs: DataFrame, net: Classifier, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    importable(docs.sparkSession)
    own = docs.select(as_column(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), held_out(as_column(id_col)).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(scores(shared.value, batch["text"]), pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    scored = own.mapInArrow(judge, f"doc_id {dict(own.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))

"""URL rules through a Bloom filter cascade: exact membership of every key of the corpus, without joins.

A rule is a (host, path) with a verdict; it fits a url whose host is the rule's
or a subdomain of it and whose path starts with the rule's.  The keys of a url
are its host's suffixes (cut at dots) with those beginnings of its path that
are as long as some rule's path: only those can be listed.  The keys of all
urls are the cascade's universe.

Level 1 is a Bloom filter of the listed keys.  Level 2 holds the universe's
keys that level 1 takes wrongly, level 3 the listed keys that level 2 takes
wrongly, and so on by turns until no key is taken wrongly.  A key's answer is
the number of leading levels that take it: odd means listed.  For every key of
the universe that is exact, so a url needs no join with the list.  Each verdict
has a cascade of its own, so that executors get filters only, never the list: a
key that a cascade takes names its rule, and the cascade its verdict.  Levels are
sized by what they hold; level 1's error rate follows the universe so that
level 2 expects about as many keys as are listed, which bounds what is sent to
executors by the list, not by the corpus.

Defined cases: of rules of equal length that fit a url the one with the longer
host decides; of rules listed twice the last one counts; a null url, or one without ``://``, has an empty host and path,
no rule and the default verdict; repeated rows give repeated results; an empty
table gives an empty result; an empty list takes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_column, importable

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT_VERDICT = "allow"
#: Error rates: the first level's highest, and that of all later levels.
FIRST_RATE = 0.05
LATER_RATE = 0.25


@dataclass(frozen=True)
class Bloom:
    """A Bloom filter over xxh3-128 hashes; ``salt`` makes the levels independent."""

    bits: np.ndarray
    hashes: int
    salt: int

    @staticmethod
    def shape(n: int, rate: float) -> tuple[int, int]:
        """(bits, hashes) for n keys."""
        bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        return bits + -bits % 64, max(1, round(-math.log2(rate)))

    def positions(self, keys: Sequence[str]) -> np.ndarray:
        pairs = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass"), self.salt) for k in keys), ">u8").reshape(-1, 2)
        step = np.arange(self.hashes, dtype=np.uint64)
        return (pairs[:, :1].astype(np.uint64) + step * (pairs[:, 1:].astype(np.uint64) | np.uint64(1))) % np.uint64(8 * len(self.bits))

    def takes(self, keys: Sequence[str]) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        at = self.positions(keys)
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)

    def with_keys(self, keys: Sequence[str]) -> Bloom:
        bits = self.bits.copy()
        if len(keys):
            at = self.positions(keys).ravel()
            np.bitwise_or.at(bits, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        return Bloom(bits, self.hashes, self.salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def depth(self, keys: Sequence[str]) -> np.ndarray:
        """How many leading levels take each key."""
        depth, alive = np.zeros(len(keys), int), np.arange(len(keys))
        for level in self.levels:
            alive = alive[level.takes([keys[i] for i in alive])]
            depth[alive] += 1
        return depth

    def listed(self, keys: Sequence[str]) -> np.ndarray:
        return self.depth(keys) % 2 == 1


def key_of(host: str, path: str) -> str:
    return f"{host}\n{path}"


def url_keys(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Keys of one url that a list with paths of these lengths could hold."""
    if not host:
        return []
    suffixes = [host] + [host[i + 1:] for i, c in enumerate(host) if c == "."]
    starts = [path[:n] for n in lengths if n <= len(path)]
    return [key_of(h, p) for h in suffixes for p in starts]


def parts(pages: DataFrame, url_col: str = "url") -> list:
    """Columns host and path of a url."""
    rest = F.regexp_extract(as_column(url_col), "(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, "(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return [F.coalesce(F.translate(host, upper, lower), F.lit("")).alias("host"),
            F.coalesce(path, F.lit("")).alias("path")]


def _taken(urls: DataFrame, firsts: dict[str, Bloom], lengths: Sequence[int]) -> DataFrame:
    """(verdict, key): the distinct keys of the universe that a verdict's level 1 takes, listed or not."""
    filters = urls.sparkSession.sparkContext.broadcast(firsts)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = sorted({k for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True) for k in url_keys(h, p, lengths)})
            taken = [(v, keys[i]) for v, level in filters.value.items() for i in np.flatnonzero(level.takes(keys))]
            yield pa.RecordBatch.from_pydict({n: pa.array([t[i] for t in taken], pa.string()) for i, n in enumerate(("verdict", "key"))})

    return urls.select("host", "path").mapInArrow(search, "verdict string, key string").distinct()


def _key_counts(urls: DataFrame, lengths: Sequence[int]) -> int:
    """About how many distinct keys the corpus has (it only sizes level 1)."""
    dots = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    return int(urls.agg(F.sum(dots * len(lengths))).first()[0] or 0)


def _levels(first: Bloom, listed: list[str], outside: list[str], later_rate: float) -> Cascade:
    """The cascade that begins with ``first``; ``outside``: the unlisted keys that it takes."""
    levels, inside, other = [first], sorted(outside), listed
    while inside:
        bits, hashes = Bloom.shape(len(inside), later_rate)
        levels.append(Bloom(np.zeros(bits // 8, np.uint8), hashes, len(levels)).with_keys(inside))
        # this level's wrong ones are among the keys of the level before
        inside, other = [k for k, t in zip(other, levels[-1].takes(other), strict=True) if t], inside
    return Cascade(tuple(levels))


def build_cascades(urls: DataFrame, listed: dict[str, list[str]], first_rate: float = FIRST_RATE,
                   later_rate: float = LATER_RATE) -> dict[str, Cascade]:
    """One cascade per verdict over the complete key universe of ``urls`` (host, path); ``listed``: each verdict's keys.

    Only the keys that a level 1 takes come to the driver, which has the list
    and tells which are unlisted: level 1's rate is lowered with the universe so
    that those are about as many as the listed keys (or a thousand), and each
    later level takes a fraction of the one before.
    """
    listed = {v: sorted(set(keys)) for v, keys in listed.items() if keys}
    if not listed:
        return {}
    lengths = sorted({len(k.split("\n", 1)[1]) for keys in listed.values() for k in keys})
    universe = _key_counts(urls, lengths)
    firsts = {}
    for v, keys in listed.items():
        bits, hashes = Bloom.shape(len(keys), min(first_rate, max(len(keys), 1000) / max(universe, 1)))
        firsts[v] = Bloom(np.zeros(bits // 8, np.uint8), hashes, 0).with_keys(keys)
    own, outside = {v: frozenset(keys) for v, keys in listed.items()}, {v: [] for v in listed}
    for row in _taken(urls, firsts, lengths).collect():
        if row.key not in own[row.verdict]:
            outside[row.verdict].append(row.key)
    return {v: _levels(firsts[v], keys, outside[v], later_rate) for v, keys in listed.items()}


def build_cascade(urls: DataFrame, rules: Iterable[tuple[str, str, str]], first_rate: float = FIRST_RATE,
                  later_rate: float = LATER_RATE) -> Cascade:
    """One cascade of all rules, whatever their verdicts."""
    return build_cascades(urls, {"": [key_of(h, p) for h, p, _ in rules]}, first_rate, later_rate).get("", Cascade(()))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT_VERDICT, first_rate: float = FIRST_RATE) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every url; the longest fitting rule decides."""
    importable(pages.sparkSession)
    urls = pages.select(as_column(id_col).alias("page_id"), *parts(pages, url_col))
    spark = pages.sparkSession
    verdict_of = {key_of(h, p): v for h, p, v in rules}
    listed: dict[str, list[str]] = {}
    for key, verdict in verdict_of.items():
        listed.setdefault(verdict, []).append(key)
    cascades = spark.sparkContext.broadcast(build_cascades(urls, listed, first_rate))
    # the lengths of paths: as many as there are different ones
    lengths = sorted({len(p) for _, p, _ in rules})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [url_keys(h, p, lengths) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)]
            universe = sorted({k for keys in each for k in keys})
            found = {universe[i]: v for v, cascade in cascades.value.items() for i in np.flatnonzero(cascade.listed(universe))}
            # keys come with the longest host first, which decides between equal lengths
            best = [max((k for k in keys if k in found), key=len, default=None) for keys in each]
            yield pa.RecordBatch.from_arrays([
                batch["page_id"], batch["host"], batch["path"],
                pa.array([None if k is None else k.replace("\n", "", 1) for k in best], pa.string()),
                pa.array([default if k is None else found[k] for k in best], pa.string()),
            ], names=["page_id", "host", "path", "rule", "verdict"])

    kind = dict(urls.dtypes)["page_id"]
    return urls.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")


ORACLE_SQL = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
cut AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path FROM cut),
fits AS (SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST, length(r.rhost) DESC) AS rn
  FROM parts p LEFT JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT_VERDICT}') AS verdict FROM fits WHERE rn = 1
"""

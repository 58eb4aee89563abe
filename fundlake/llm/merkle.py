"""Merkle manifest of a dataset, its trees stored in van Emde Boas order.

Each row is a leaf.  The leaves of a group (a language) are a binary hash tree,
and the groups' roots are the leaves of one more.  A tree is cut into aligned
blocks of ``2 ** BLOCK_HEIGHT`` leaves.  One task builds a block and stores it as
one array of digests in van Emde Boas order: the upper half of its levels first,
then each lower subtree, every part laid out in the same way, so that a path
from leaf to root touches few stretches of memory whatever the size of a cache
line or page.  ``address`` finds a node from its depth and index alone; it
serves both building and looking up siblings.  The blocks' roots are the leaves
of the next storey, so a group of any size is built and proved block by block:
no task holds more than one block, and each storey is ``2 ** BLOCK_HEIGHT``
times smaller.

A node is the lowercase hex sha256 of its children's hex digests; while a
level has several nodes, its last one may have a single child.  A leaf is the
hash of its row's fields, each ``-`` if null, else byte count, ``:``, value.

Defined cases: nulls are hashed as ``-``; rows without a group's value are a group
of their own, the first; rows without doc_id come first in theirs and are never
tampered with; rows that share a doc_id go by their leaf's digest, equal rows
each have a leaf; a group of one row has its leaf as root; extra columns are
ignored; an empty table gives an empty result and has no root.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_column, importable, staged
from .order import group_key, numbered, placed

#: Levels of hashing in one block: 4,096 leaves, 256 KiB of digests.
BLOCK_HEIGHT = 12
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCK = "g string, block long, n long, root binary, layout binary"


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0: root) in the layout of a complete tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = depth - top
    subtree = (1 << (levels - top)) - 1
    return (1 << top) - 1 + (index >> below) * subtree + address(levels - top, below, index & ((1 << below) - 1))


def height(n: int, block_height: int) -> int:
    """Levels of hashing in a block of a storey of ``n`` nodes: all of them only where other blocks follow."""
    return min(block_height, (n - 1).bit_length())


def width(n: int, level: int) -> int:
    """Nodes left of ``n`` after ``level`` levels."""
    return -(-n >> level) if n else 0


def node(children: Sequence[bytes]) -> bytes:
    return sha256(b"".join(c.hex().encode() for c in children)).digest()


def build(leaves: np.ndarray, levels_up: int) -> np.ndarray:
    """The layout of the tree over ``leaves`` (rows of DIGEST bytes); absent nodes stay 0."""
    levels = levels_up + 1
    layout = np.zeros(((1 << levels) - 1, DIGEST), np.uint8)
    row, at = leaves, np.arange(len(leaves))
    layout[address(levels, levels_up, at)] = row
    for depth in range(levels_up - 1, -1, -1):
        digests = [bytes(x) for x in row]
        parents = b"".join(node(digests[i:i + 2]) for i in range(0, len(digests), 2))
        row = np.frombuffer(parents, np.uint8).reshape(-1, DIGEST)
        layout[address(levels, depth, np.arange(len(row)))] = row
    return layout


def siblings(layout: np.ndarray, levels_up: int, held: int, at: np.ndarray) -> list[list[bytes]]:
    """Each leaf's siblings inside its block, bottom up; ``held`` leaves are in the block, ``at`` are the ones asked for."""
    found: list[list[bytes]] = [[] for _ in at]
    for level in range(levels_up):
        other = (at >> level) ^ 1
        there = np.flatnonzero(other < width(held, level))
        digests = layout[address(levels_up + 1, levels_up - level, other[there])]
        for i, digest in zip(there.tolist(), digests, strict=True):
            found[i].append(digest.tobytes())
    return found


def fold(leaf: bytes, proof: Sequence[bytes], places: Sequence[tuple[int, int]]) -> bytes:
    """The root that a leaf and its siblings give; ``places`` are its (place, size) in each tree on the way up."""
    at, digest = 0, leaf
    for place, n in places:
        while n > 1:
            if place ^ 1 < n:
                digest = node((proof[at], digest) if place & 1 else (digest, proof[at]))
                at += 1
            else:
                digest = node((digest,))
            place, n = place >> 1, (n + 1) >> 1
    return digest


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (g, pos, n, digest, ...) and the storeys over them, then those over the groups' roots.

    A storey is a table of blocks (g, block, n, root, layout): n nodes of group g
    are below that storey, and the block's root is node ``block`` of the next.
    """

    leaves: DataFrame
    storeys: list[DataFrame]
    groups: DataFrame
    top: list[DataFrame]
    block_height: int

    def roots(self) -> DataFrame:
        """(g, subroot) of every group."""
        return self.groups.select("g", F.col("digest").alias("subroot"))

    def root(self) -> DataFrame:
        """(root): one row, none for an empty dataset."""
        return self.top[-1].select(F.col("root"))


def _blocks(nodes: DataFrame, block_height: int, name: str) -> DataFrame:
    """The blocks over ``nodes`` (g, pos, n, digest)."""

    def one(key: tuple, part: pa.Table) -> pa.Table:
        g, block = key[0].as_py(), key[1].as_py()
        n = part["n"][0].as_py()
        at = part["pos"].to_numpy() - (block << block_height)
        leaves = np.empty((len(at), DIGEST), np.uint8)
        leaves[at] = np.frombuffer(b"".join(part["digest"].to_pylist()), np.uint8).reshape(-1, DIGEST)
        layout = build(leaves, height(n, block_height))
        return pa.table({"g": [g], "block": pa.array([block], pa.int64()), "n": pa.array([n], pa.int64()),
                         "root": pa.array([layout[0].tobytes()], pa.binary()), "layout": pa.array([layout.tobytes()], pa.binary())})

    keyed = nodes.select("g", F.shiftright("pos", block_height).alias("block"), "pos", "n", "digest")
    return staged(keyed.groupBy("g", "block").applyInArrow(one, _BLOCK), name)


def _storeys(nodes: DataFrame, block_height: int, name: str) -> list[DataFrame]:
    """Storeys from the leaves up, until every group has one root; their number follows the logarithm of the largest group."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out, size = [], 1 << block_height
    while True:
        out.append(_blocks(nodes, block_height, f"{name}-blocks"))
        most = -(-most // size)
        if most <= 1:
            return out
        nodes = out[-1].where(F.col("n") > size).select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / size).cast("long").alias("n"),
                                                        F.col("root").alias("digest"))


def manifest(leaves: DataFrame, keys: Sequence[str], block_height: int = BLOCK_HEIGHT) -> Manifest:
    """The manifest of ``leaves`` (g, digest, and ``keys`` that order a group; a staged table)."""
    importable(leaves.sparkSession)
    own = staged(placed(leaves, "g", keys, "merkle"), "merkle-leaves")
    storeys = _storeys(own, block_height, "merkle")
    size = 1 << block_height
    # a group's root is the one block of its last storey
    ends = [s.where(F.col("n") <= size).select("g", F.col("root").alias("digest")) for s in storeys]
    groups = staged(functools.reduce(DataFrame.unionByName, ends).withColumn("all", F.lit("")), "merkle-groups")
    above = placed(groups, "all", ["g"], "merkle-top").select(F.col("all").alias("g"), F.col("g").alias("key"), "pos", "n", "digest")
    above = staged(above, "merkle-top")
    return Manifest(own, storeys, above.select(F.col("key").alias("g"), "pos", "n", "digest"), _storeys(above, block_height, "merkle-top"), block_height)


def _held(n: int, block: int, block_height: int) -> int:
    return min(n - (block << block_height), 1 << block_height)


def _child_paths(blocks: DataFrame, block_height: int) -> DataFrame:
    """(g, pos, path): the siblings from each node under ``blocks`` (with ``path`` above their roots) up to the top."""

    def one(part: pa.Table) -> pa.Table:
        row = part.to_pylist()[0]
        held = _held(row["n"], row["block"], block_height)
        found = siblings(np.frombuffer(row["layout"], np.uint8).reshape(-1, DIGEST), height(row["n"], block_height), held, np.arange(held))
        return pa.table({"g": pa.array([row["g"]] * held, pa.string()), "pos": pa.array((row["block"] << block_height) + np.arange(held), pa.int64()),
                         "path": pa.array([b"".join(f) + row["path"] for f in found], pa.binary())})

    return blocks.select("g", "block", "n", "layout", "path").groupBy("g", "block").applyInArrow(one, "g string, pos long, path binary")


def _with_paths(storeys: list[DataFrame], ends: DataFrame, block_height: int, name: str) -> DataFrame:
    """The lowest storey's blocks with the path from each block's root to the top; ``ends`` (g, path) are those of the groups' roots."""
    size, held = 1 << block_height, None
    for storey in reversed(storeys):
        last = storey.where(F.col("n") <= size).join(ends, "g")
        if held is not None:
            inner = storey.where(F.col("n") > size).join(_child_paths(held, block_height).withColumnRenamed("pos", "block"), ["g", "block"])
            last = last.unionByName(inner)
        held = staged(last, f"{name}-paths")
    return held


def proofs(made: Manifest, columns: Sequence[str], changed: str) -> DataFrame:
    """Every leaf's ``columns``, digest, subroot, root and proof, and the root that leaf ``changed`` folds to with them.

    (..., leaf, subroot, root, proof_sha256, folded_root, verified), digests in hex.
    """
    bh = made.block_height
    top_row = made.root().first()
    root = bytes(top_row[0]) if top_row else b""
    over = made.top[-1].select("g", F.lit(b"").alias("path"))
    above = _child_paths(_with_paths(made.top, over, bh, "merkle-top"), bh).select(F.col("pos").alias("group_pos"), "path")
    ends = staged(made.groups.select("g", F.col("pos").alias("group_pos"), F.col("n").alias("n_groups"), F.col("digest").alias("subroot"))
                  .join(above, "group_pos"), "merkle-ends")
    blocks = _with_paths(made.storeys, ends.select("g", "path"), bh, "merkle").join(ends.drop("path"), "g")
    own = made.leaves.select("g", F.shiftright("pos", bh).alias("block"), "pos", "digest", F.col(changed).alias("changed"), *columns)
    kinds = dict(made.leaves.dtypes)
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in columns], "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"])

    def prove(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        block = blocks.to_pylist()[0]
        n, first = block["n"], block["block"] << bh
        at = leaves["pos"].to_numpy()
        inside = siblings(np.frombuffer(block["layout"], np.uint8).reshape(-1, DIGEST), height(n, bh), _held(n, block["block"], bh), at - first)
        upper = [block["path"][i:i + DIGEST] for i in range(0, len(block["path"]), DIGEST)]
        upper_hex, group = block["path"].hex(), (block["group_pos"], block["n_groups"])
        folded, proof = [], []
        for place, leaf, near in zip(at.tolist(), leaves["changed"].to_pylist(), inside, strict=True):
            folded.append(fold(leaf, near + upper, ((place, n), group)))
            proof.append(sha256((b"".join(near).hex() + upper_hex).encode()).hexdigest())
        return pa.table([*[leaves[c] for c in columns], pa.array([x.hex() for x in leaves["digest"].to_pylist()], pa.string()),
                         pa.array([block["subroot"].hex()] * len(at), pa.string()), pa.array([root.hex()] * len(at), pa.string()),
                         pa.array(proof, pa.string()), pa.array([x.hex() for x in folded], pa.string()), pa.array([x == root for x in folded], pa.bool_())],
                        names=[*columns, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return own.groupBy("g", "block").cogroup(blocks.groupBy("g", "block")).applyInArrow(prove, schema)


def field(column: Column) -> Column:
    """A leaf's text of one value: ``-`` if null, else byte count, ``:``, value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def tampered_id(doc_id: Column) -> Column:
    """Whether 7 divides the crc32 of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def document_leaves(docs: DataFrame) -> DataFrame:
    """(g, doc_id, digest, changed, row): each document's leaf and the one it has after tampering; only digests go on."""
    columns = {f: as_column(f) for f in FIELDS}
    changed = {**columns, "n_chars": columns["n_chars"] + F.when(tampered_id(columns["doc_id"]), 1).otherwise(0)}
    digest = leaf_digest([columns[f] for f in FIELDS])
    own = docs.select(group_key(columns["lang"]).alias("g"), columns["doc_id"].cast("long").alias("doc_id"), digest.alias("digest"),
                      F.when(tampered_id(columns["doc_id"]), leaf_digest([changed[f] for f in FIELDS])).alias("changed"))
    return staged(numbered(own.withColumn("changed", F.coalesce("changed", "digest"))), "merkle-rows")


def document_proofs(docs: DataFrame, block_height: int = BLOCK_HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document."""
    importable(docs.sparkSession)
    return proofs(manifest(document_leaves(docs), ["doc_id", "digest", "row"], block_height), ["doc_id"], "changed")


_FIELD = "COALESCE(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f"({{{f}}})") for f in FIELDS) + ")"
# crc32 of the decimal id, bit by bit: polynomial and start value are those of the standard
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
  lambda c, d: list_reduce(list_prepend(xor(c, d), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT)"""
_PARENTS = "list_transform(range(1, len(h) + 1, 2), lambda i: sha256(h[i] || COALESCE(h[i + 1], '')))"

#: Independent statement: whole levels as lists, folded level by level.
ORACLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, COALESCE('=' || lang, '') AS g, {_LEAF.format(**{f: f for f in FIELDS})} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_LEAF.format(**{**{f: f for f in FIELDS}, 'n_chars': 'n_chars + 1'})} END AS changed
  FROM documents),
own AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
levels(g, k, h) AS (
  SELECT g, 0, list(leaf ORDER BY p) FROM own GROUP BY g
  UNION ALL SELECT g, k + 1, {_PARENTS} FROM levels WHERE len(h) > 1),
subroots AS (SELECT g, h[1] AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS q FROM levels WHERE len(h) = 1),
tops(k, h) AS (
  SELECT 0, list(subroot ORDER BY q) FROM subroots
  UNION ALL SELECT k + 1, {_PARENTS} FROM tops WHERE len(h) > 1),
heights AS (SELECT g, max(k) AS height FROM levels GROUP BY g),
every AS (
  SELECT l.g, k, h, len(h) > 1 AS goes_up FROM levels l
  UNION ALL SELECT s.g, t.k + s.height, t.h, len(t.h) > 1 FROM heights s, tops t),
folded(doc_id, g, leaf, row, k, p, now, proof) AS (
  SELECT doc_id, g, leaf, row_number() OVER (), 0, CASE WHEN height = 0 THEN q ELSE p END, COALESCE(changed, leaf), ''
  FROM own JOIN heights USING (g) JOIN subroots USING (g)
  UNION ALL
  SELECT f.doc_id, f.g, f.leaf, f.row, f.k + 1, CASE WHEN f.k + 1 = s.height THEN u.q ELSE f.p // 2 END,
         sha256(CASE WHEN f.p % 2 = 1 THEN e.h[f.p] || f.now ELSE f.now || COALESCE(e.h[f.p + 2], '') END),
         f.proof || CASE WHEN f.p % 2 = 1 THEN e.h[f.p] ELSE COALESCE(e.h[f.p + 2], '') END
  FROM folded f JOIN every e ON e.g = f.g AND e.k = f.k AND e.goes_up JOIN heights s ON s.g = f.g JOIN subroots u ON u.g = f.g)
SELECT f.doc_id, f.leaf, u.subroot, t.h[1] AS root, sha256(f.proof) AS proof_sha256, f.now AS folded_root, f.now = t.h[1] AS verified
FROM folded f JOIN heights s ON s.g = f.g JOIN subroots u ON u.g = f.g JOIN tops t ON len(t.h) = 1
WHERE f.k = s.height + t.k"""

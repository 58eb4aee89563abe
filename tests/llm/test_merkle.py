"""The Merkle manifest against its definition."""

from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import pytest
from llm_cases import SCHEMA, awkward, empty

from fundlake.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*inputs):
    return sha256("".join(inputs).encode()).hexdigest()


def plain_leaf(row, add=0):
    values = dict(row, n_chars=None if row["n_chars"] is None else row["n_chars"] + add)
    return digest(*["-" if values[f] is None else f"{len(str(values[f]).encode())}:{values[f]}" for f in ("doc_id", "source", "lang", "n_chars", "text")])


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_proofs(rows):
    groups = {}
    for r in rows:
        groups.setdefault(b"" if r["lang"] is None else b"=" + r["lang"].encode(), []).append(r)
    names = sorted(groups)
    for held in groups.values():
        held.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    trees = {g: plain_tree([plain_leaf(r) for r in groups[g]]) for g in names}
    top = plain_tree([trees[g][-1][0] for g in names]) if names else []
    out = []
    for q, g in enumerate(names):
        for p, r in enumerate(groups[g]):
            tampered = r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 7 == 0
            now, proof = plain_leaf(r, 1 if tampered else 0), []
            for levels, place in ((trees[g], p), (top, q)):
                for level in levels[:-1]:
                    run = level[place - place % 2:place - place % 2 + 2]
                    proof += run[:place % 2] + run[place % 2 + 1:]
                    run[place % 2] = now
                    now, place = digest(*run), place // 2
            out.append((r["doc_id"], plain_leaf(r), trees[g][-1][0], top[-1][0], digest(*proof), now, now == top[-1][0]))
    return sorted(out, key=str)


def found(docs, height=merkle.BLOCK_HEIGHT):
    made = merkle.document_proofs(docs, height)
    assert made.columns == COLUMNS
    return sorted((tuple(r) for r in made.collect()), key=str)


@pytest.mark.parametrize(("sizes", "height"), [([1], 12), ([2, 1, 3], 1), ([17, 5, 64, 65], 2), ([300, 1, 33], 4)])
def test_proofs_equal_the_definition(spark, sizes, height):
    rows = [(i * 10 + k, f"text {i} {k}", [None, "en", "é", "z"][k], "src", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(docs, height) == plain_proofs([r.asDict() for r in docs.collect()])


def test_awkward_rows_and_an_empty_table(spark):
    docs = awkward(spark)
    assert found(docs, 2) == plain_proofs([r.asDict() for r in docs.collect()])
    assert found(empty(spark)) == []


def test_many_equal_rows(spark):
    rows = [(1, "same", "en", "src", 4)] * 3000 + [(None, "none", "en", "src", 4)] * 500
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(docs, 5) == plain_proofs([r.asDict() for r in docs.collect()])


def test_sql_takes_groups_of_one(spark):
    rows = [(1, "a", "en", "s", 1), (2, None, None, "s", None), (None, "c", "en", None, 3), (3, "d", "fr", "s", 1), (9, "e", "fr", "s", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(merkle.ORACLE_SQL).fetchall(), key=str) == found(docs)


@pytest.mark.parametrize("levels", [1, 2, 3, 5, 8, 13])
def test_addresses_split_at_half_height(levels):
    """Every node has a place of its own; the upper half of the levels comes first and each lower subtree is in one piece."""
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    top = levels // 2
    if top:
        assert max(p.max() for p in places[:top]) == (1 << top) - 2
        for subtree in range(1 << top):
            own = np.concatenate([places[d].reshape(1 << top, -1)[subtree] for d in range(top, levels)])
            assert own.max() - own.min() == len(own) - 1


def test_a_changed_leaf_does_not_verify(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", i) for i in range(200)], SCHEMA)
    for r in merkle.document_proofs(docs, 3).collect():
        assert r.verified == (crc32(str(r.doc_id).encode()) % 7 != 0)

"""Conversation repair against a plain search over all edits."""

import functools
import random
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
from conftest import SF01
from pyspark.sql import functions as F

from fundlake.llm import conversation, queries
from fundlake.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    """conv_id -> [(turn, role, text)] by turn; dropped rows leave their conversation."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept.extend([(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
    return out


def plain_repair(rows):
    """The contract's columns of one conversation, by memoised search; the least (cost, audit) of all edits."""
    faults, seen = [], set()
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, inserts):
        """(cost, audit, repaired lines) from row i on."""
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 2:
            for r in follows[state]:
                if r != "s":
                    c, a, t = best(i, r, inserts + 1)
                    options.append((c + 5, "I" + a, ({"u": "user", "a": "assistant"}[r] + ":", *t)))
        if i < len(rows):
            c, a, t = best(i + 1, state, 0)
            options.append((c + 2, "D" + a, t))
            _, role, text = rows[i]
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if role[:1] and role[:1] in follows[state]:
                    c, a, t = best(i + 1, role[0], 0)
                    options.append((c + more, "K" + a, (f"{role}:{text}", *t)))
                for new in ("user", "assistant"):
                    if new[0] in follows[state]:
                        c, a, t = best(i + 1, new[0], 0)
                        options.append((c + 1 + more, "R" + a, (f"{new}:{text}", *t)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, block=conversation.BLOCK):
    got = conversation.repair(spark.createDataFrame(rows, SCHEMA).repartition(3), block).collect()
    want = {conv: plain_repair(kept) for conv, kept in plain_damage(rows).items()}
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r.conv_id], (r.conv_id, plain_damage(rows)[r.conv_id])


def some_rows(rng, conversations, longest):
    texts = ["Yes.", "no", "Is it? ", "", " \t\n", "a.\x0b", "long one!", None, "é? ", "ok"]
    return [(c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sue", "aide"]), rng.choice(texts) if rng.random() < 0.4 else f"w{rng.random()}.")
            for c in range(conversations) for turn in rng.sample(range(longest + 3), rng.randint(1, longest))]


def test_repair_equals_search(spark):
    rng = random.Random(1)
    check(spark, some_rows(rng, 120, 9) + some_rows(rng, 1, 60))


def test_blocks_join_to_the_same_repair(spark):
    rng = random.Random(2)
    check(spark, some_rows(rng, 30, 14), block=3)


def test_awkward_conversations(spark):
    same = [(7, 1, "user", "Hi.")] * 40
    check(spark, [(None, None, None, None), (None, 3, "user", "A."), (None, 3, "user", "A."), (1, None, "user", "B."), (1, None, "assistant", "C."),
                  (2, 5, "assistant", "x"), (3, -4, "system", "S."), (3, 9, "user", "U."), *same])


def test_empty_table_and_extra_columns(spark):
    assert conversation.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, 2, "user", "A."), (1, 3, "assistant", "B.")], SCHEMA)
    for name in ("g", "kind", "pos", "n", "Block", "a.b", "key"):
        clash = clash.withColumn(name, F.lit(1))
    assert conversation.repair(clash).count() == 1


def test_one_hot_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(3000)] + [(2, 1, "user", "x.")]
    got = {r.conv_id: r for r in conversation.repair(spark.createDataFrame(rows, SCHEMA), block=256).collect()}
    one = {r.conv_id: r for r in conversation.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == one and set(got[1].audit) <= set("DIKR") and got[1].cost > 0


def test_ranks_order_nodes_as_their_audits_do():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 12, 40)
    begin = np.array([0, 7, 8, 25, 40])
    go = conversation.costs_to_go(codes, begin, np.array([conversation._END] * 4))
    good, target = conversation._arcs(codes, begin, go, np.ones(4, bool))
    pointers, letter, rank = conversation.rank_paths(good, target, np.arange(len(good)))

    def audit(v):
        out = ""
        while letter[v] >= 0:
            out += "DIKR"[letter[v]]
            v = pointers[0][v]
        return out

    audits = [audit(v) for v in range(len(good))]
    order = {a: i for i, a in enumerate(sorted(set(audits)))}
    assert [order[a] for a in audits] == rank.tolist()


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF01, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = {conv: plain_repair(kept) for conv, kept in plain_damage(rows).items()}
    got = queries.op12_conversation(spark, SF01).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)

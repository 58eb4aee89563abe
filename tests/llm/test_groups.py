"""Operators that compare rows with each other, against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from llm_cases import awkward, documents, empty, words
from test_shared import plain_shingles

from pyspark.sql import functions as F

from fundlake.llm import fingerprint, line_dedup, minhash, nn_descent, suffix_dedup


def smallest_reachable(ids, links):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


# near-dedup by sketches


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = words(rng, 1)
        out.append(" ".join(w))
    return out


def plain_components(rows):
    sets = {i: plain_shingles(t or "") for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in smallest_reachable(ids, links).items()}


@pytest.mark.parametrize("seed, tile_bytes", [(1, 4 << 20), (2, 5000)])
def test_near_duplicates_equal_brute_force(spark, seed, tile_bytes, monkeypatch):
    """A crowded family with a continuum of similarities, pairs, copies, short and empty texts; also in many small tiles."""
    monkeypatch.setattr(minhash, "TILE_BYTES", tile_bytes)
    rng = random.Random(seed)
    texts = variants(rng, words(rng, 60), 120, 5) + variants(rng, words(rng, 25), 10, 1) + variants(rng, words(rng, 80), 6, 2) * 2
    texts += [words(rng, rng.randint(1, 30)) for _ in range(40)] + ["", None, "  ", "a b", "A B", "a b c"]
    rng.shuffle(texts)
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == plain_components(rows)


def test_sketches_estimate_resemblance_and_fill():
    rng = np.random.default_rng(1)
    errors = []
    for n in (1, 2, 10, 200, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        assert (minhash.sketch(a) != 2**64 - 1).all()
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**63, n - n // 2).astype(np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(abs((minhash.sketch(a) == minhash.sketch(b)).mean() - true))
    assert max(errors) < 0.15
    a = np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))
    slow = [min((i << 32) | int(h & np.uint64(2**32 - 1)) for i in range(2 * minhash.COORDINATES) for h in minhash.mix(a ^ minhash._ROUND[i])
                if (int(h >> np.uint64(32)) * minhash.COORDINATES >> 32 if i < minhash.COORDINATES else i - minhash.COORDINATES) == b) for b in range(0, 144, 29)]
    assert [int(minhash.sketch(a)[b]) for b in range(0, 144, 29)] == slow


def test_near_duplicates_of_awkward_rows(spark):
    rows = minhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 14
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append((r.component_id, r.kept))
    assert by_id[5] == [(4, False)] * 2 and by_id[4] == [(4, True)] and by_id[1] == [(1, True)]
    assert by_id[None] == [(None, True)] * 2 and by_id[6] == [(6, True)] * 2
    kept = minhash.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "6", "6", "7", "8", "9", "10", "None", "None"])
    assert minhash.near_duplicates(empty(spark)).count() == 0 and minhash.keep_one(empty(spark)).count() == 0


def test_rows_that_share_a_doc_id_keep_their_own_links(spark):
    """(1, A), (1, B), (2, near A), (3, near B): two groups, both named by doc 1, and one row of each stays."""
    rng = random.Random(12)
    a, b = words(rng, 200), words(rng, 200)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, b + " more")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, rows)).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False)]
    assert sorted((r.doc_id, r.text) for r in minhash.keep_one(documents(spark, rows)).collect()) == sorted([(1, a), (1, b)])


def test_proposed_pairs_grow_with_the_family(spark, monkeypatch):
    """A family of n near copies proposes pairs in proportion to n, not to n times its bands."""
    rng = random.Random(13)
    base, seen = words(rng, 200), []
    verified = minhash._verified
    monkeypatch.setattr(minhash, "_verified", lambda pairs, sets: seen.append(pairs.count()) or verified(pairs, sets))
    for n in (100, 300):
        rows = [(i, t) for i, t in enumerate(variants(rng, base, n, 3))]
        seen.clear()
        assert {r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()} == {0}
        assert sum(seen) <= 3 * n


# substring dedup


def plain_removed(texts, length):
    coded = [(t or "").encode() for t in texts]
    starts = collections.Counter(c[i:i + length] for c in coded for i in range(len(c) - length + 1))
    out = []
    for c in coded:
        gone = np.zeros(len(c), bool)
        for i in range(len(c) - length + 1):
            if starts[c[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((len(c), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(c) else 0,
                    hashlib.sha256(bytes(b for b, g in zip(c, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("anchor_bytes, array_bytes", [(8 << 20, 1 << 20), (3000, 1000)])
def test_suffix_dedup_equals_brute_force(spark, anchor_bytes, array_bytes, monkeypatch):
    """Shared passages at all borders, overlaps, periodic texts, multi-byte characters; also with anchors taken apart."""
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", anchor_bytes)
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", array_bytes)
    rng = random.Random(6)
    passages = [words(rng, 80), words(rng, 60), "é" * 150 + words(rng, 50)]
    texts = [words(rng, rng.randint(0, 30)) + (p := rng.choice(passages))[:rng.randint(190, len(p))] + words(rng, rng.randint(0, 30)) for _ in range(40)]
    texts += ["ab" * 200, "a" * 500, "", None, "b" * 199, "b" * 199, "c" * 200, "c" * 200, passages[0][:199], words(rng, 300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(documents(spark, rows)).collect()}
    assert got == dict(enumerate(plain_removed(texts, 200)))


def test_suffix_dedup_of_awkward_rows(spark):
    docs = awkward(spark)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs).collect())
    rows = docs.collect()
    assert got == sorted((str(r.doc_id), *x) for r, x in zip(rows, plain_removed([r.text for r in rows], 200), strict=True))
    kept = {r.doc_id: (r.kept, r.removed) for r in suffix_dedup.suffix_dedup(docs, keep_text=True).collect()}
    assert kept[7] == (b"", [0, 30_000]) and kept[10] == (b"mail a.b@c.de now", [])
    assert suffix_dedup.suffix_dedup(empty(spark)).count() == 0


def test_suffix_dedup_of_many_repeated_rows(spark):
    """5,000 equal rows with one id and 1,000 without any: every byte of each occurs elsewhere; others keep theirs."""
    rng = random.Random(14)
    a, b, c = words(rng, 120), words(rng, 100), words(rng, 100)
    docs = documents(spark, [(1, a)] * 5000 + [(None, b)] * 1000 + [(2, c)])
    got = suffix_dedup.suffix_dedup(docs).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r["count"]) for r in got)) == sorted([
        ("1", len(a), len(a), 1, 5000), ("None", len(b), len(b), 1, 1000), ("2", len(c), 0, 0, 1)])


def test_segments_cover_all_windows_in_slices(monkeypatch):
    rng = random.Random(9)
    texts = [words(rng, n).encode() for n in (500, 3, 0, 90, 200)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for size in (4 << 20, 333):
        monkeypatch.setattr(suffix_dedup, "SLICE", size)
        text, start, windows, _ = suffix_dedup.segments(data, offsets)
        places = [(t, p - offsets[t]) for t, s, w in zip(text, start, windows, strict=True) for p in range(s, s + w)]
        assert sorted(places) == [(t, p) for t, x in enumerate(texts) for p in range(len(x) - 199)]


# line dedup


def plain_lines(rows):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i:i + 3])
            if window in seen:
                gone.update((i, i + 1, i + 2))
            seen.add(window)
        out.append((doc, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def test_line_dedup_equals_one_pass(spark):
    rng = random.Random(8)
    pool = [words(rng, 3) for _ in range(12)] + [""]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(60)] + [(60, None), (61, "x\nx\nx\nx\nx")]
    got = [(r.doc_id, r.n_lines, r.n_removed, r.text or "") for r in line_dedup.line_dedup(documents(spark, rows)).collect()]
    assert sorted(got) == sorted(plain_lines(rows))


def test_line_dedup_of_awkward_rows(spark):
    docs = awkward(spark)
    out = line_dedup.line_dedup(docs)
    assert out.columns == [*docs.columns, "n_lines_", "n_removed_"]
    got = {(r.doc_id, r.text): r["n_removed_"] for r in out.collect()}
    assert out.count() == 14 and got[(5, "")] == 150 and got[(2, None)] == 0
    assert line_dedup.line_dedup(empty(spark)).count() == 0


# vectors


def test_near_vectors_equal_brute_force(spark):
    """A clique larger than any list, pairs, a chain, copies, and vectors that cannot be compared."""
    rng = np.random.default_rng(3)

    def around(v, n, cosine):
        noise = rng.normal(size=(n, len(v)))
        noise -= np.outer(noise @ v, v)
        noise /= np.linalg.norm(noise, axis=1)[:, None]
        return cosine * v + np.sqrt(1 - cosine**2) * noise

    def unit():
        v = rng.normal(size=32)
        return v / np.linalg.norm(v)

    rows = [(v * rng.uniform(0.1, 9), 1) for v in around(unit(), 60, 0.98)]
    for _ in range(15):
        v = unit()
        rows += [(v, 1), (around(v, 1, 0.95)[0], int(rng.integers(1, 3)))]
    rows += [(unit(), int(rng.integers(1, 4))) for _ in range(150)]
    rows += [(rows[0][0], 1), (rows[0][0], 2), (rows[0][0], 1)]
    vectors = [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 32, 1), (1003, [None] * 32, 1), (1004, [float("nan")] * 32, 1), (1005, [float("inf")] * 32, 1),
           (1006, vectors[0][1], None), (1007, vectors[0][1][:5], 1), (None, vectors[0][1], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nn_descent.near_vectors(
        spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>, label int")).collect()}
    links = []
    for i, v, label in vectors:
        for j, w, other in vectors[:i]:
            if label == other and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                links.append((j, i))
    degree = collections.Counter(x for link in links for x in link)
    root = smallest_reachable([i for i, _, _ in vectors], links)
    want = {i: (degree[i], root[i], root[i] == i) for i, _, _ in vectors} | {i: (0, i, True) for i, _, _ in odd}
    assert got == want
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert nn_descent.near_vectors(nothing).count() == 0


def brute_vectors(rows):
    """(links, root) of every vector of one label."""
    units = np.array(rows) / np.linalg.norm(rows, axis=1)[:, None]
    linked = units @ units.T >= nn_descent.COSINE
    np.fill_diagonal(linked, False)
    root = smallest_reachable(range(len(rows)), np.argwhere(np.triu(linked)).tolist())
    return {i: (int(linked[i].sum()), root[i], root[i] == i) for i in range(len(rows))}


def near_rows(rng, centre, n, cosine):
    noise = rng.normal(size=(n, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    return cosine * centre + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise, axis=1)[:, None]


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("part", [1024, 16])
def test_links_between_saturated_cliques_are_found(spark, part, monkeypatch):
    """Two tight groups larger than any list, linked only across: every list fills with its own group; also in many small tiles."""
    monkeypatch.setattr(nn_descent, "PART", part)
    rng = np.random.default_rng(5)
    first = rng.normal(size=64)
    first /= np.linalg.norm(first)
    second = near_rows(rng, first, 1, 0.95)[0]
    rows = [*near_rows(rng, first, 25, 0.997), *near_rows(rng, second, 25, 0.997), *rng.normal(size=(30, 64))]
    want = brute_vectors(rows)
    assert len({want[i][1] for i in range(50)}) == 1 and min(want[i][0] for i in range(50)) > 24
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nn_descent.near_vectors(vectors_of(spark, rows)).collect()}
    assert got == want


def test_lists_grow_past_a_clique(spark, monkeypatch):
    """The same two groups with no exact comparison at all: lists twice as long, and again, find the links across."""
    rng = np.random.default_rng(5)
    first = rng.normal(size=64)
    first /= np.linalg.norm(first)
    second = near_rows(rng, first, 1, 0.95)[0]
    rows = [*near_rows(rng, first, 15, 0.997), *near_rows(rng, second, 15, 0.997), *rng.normal(size=(30, 64))]
    want = brute_vectors(rows)
    assert len({want[i][1] for i in range(30)}) == 1 and min(want[i][0] for i in range(30)) > nn_descent.K
    monkeypatch.setattr(nn_descent, "_exact_edges", lambda classes: spark.createDataFrame([], "a long, b long"))
    got = nn_descent.near_vectors(vectors_of(spark, rows)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want and {r.recall for r in got} == {1.0}


def test_rows_that_share_a_vec_id_have_their_own_links(spark):
    x, y = np.eye(16)[0], np.eye(16)[1]
    rows = [(1, x), (1, y), (2, x + 0.1 * np.eye(16)[2]), (3, y + 0.1 * np.eye(16)[3]), (4, np.eye(16)[5])]
    got = nn_descent.near_vectors(spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4)]


def test_audit_sees_small_groups_beside_a_clique(spark, monkeypatch):
    """A graph that has lost the links of all pairs does not pass, and after the last try everything is compared exactly."""
    rng = np.random.default_rng(8)
    rows = [*near_rows(rng, np.eye(64)[0], 120, 0.99)]
    for _ in range(4):
        v = rng.normal(size=64)
        rows += [v, near_rows(rng, v / np.linalg.norm(v), 1, 0.96)[0]]
    graph, kept = nn_descent.neighbour_graph, []

    def lossy(*args):
        kept.append(graph(*args).join(args[0].where("first < 120"), "node", "left_semi"))
        return kept[-1]

    monkeypatch.setattr(nn_descent, "neighbour_graph", lossy)
    monkeypatch.setattr(nn_descent, "TRIES", 1)
    want = brute_vectors(rows)
    assert all(want[i][0] == 1 for i in range(120, 128))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nn_descent.near_vectors(vectors_of(spark, rows)).collect()}
    assert got == want and len(kept) == 1


# fingerprints


def test_edited_fingerprints_equal_the_definition(spark):
    rng = random.Random(12)
    texts = [words(rng, rng.randint(0, 300)) for _ in range(40)] + ["", None, "é漢\U0001f600x" * 9, "a b", "same text here", "same text here"]
    rows = [(7 * i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    for parts in (1, 6, 100):
        got = {r.doc_id: r for r in fingerprint.edited_fingerprints(documents(spark, rows), parts=parts).collect()}
        assert sorted(got) == sorted(i for i, _ in rows)
        order = [(i, t or "") for i, t in sorted(rows)]
        for (i, text), (j, after) in zip(order, order[1:] + order[:1], strict=True):
            n = len(text) // 4
            edited = text[:len(text) - n] + after[:n]
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            for other, value in ((edited, r.near_edited), (after, r.near_next)):
                a, b = plain_shingles(text), plain_shingles(other)
                true = len(a & b) / len(a | b) if a and b else float(len(a) == len(b))
                assert value == pytest.approx(true, abs=0.2) if len(a | b) > fingerprint.K else value == pytest.approx(true)
    assert got[7 * 44].fingerprint == got[7 * 45].fingerprint


@pytest.mark.parametrize("hot", [None, 5])
def test_rows_of_one_id_spread_and_keep_their_order(spark, hot):
    """A third of all rows without an id, or with the same one: no task holds them all, and every row's next one is right."""
    rng = random.Random(31)
    rows = [(i, words(rng, 8)) for i in range(200)] + [(hot, words(rng, 8)) for _ in range(300)] + [(hot, "the same text in many equal rows of it")] * 60
    docs = documents(spark, rows)
    placed = fingerprint.in_order(docs.select("doc_id", "text"), 16).withColumn("task", F.spark_partition_id()).collect()
    held = collections.Counter(r.task for r in placed if not r.guest)
    guests = collections.Counter(t for t, _, _ in {(r.task, r.doc_id, r.text) for r in placed if r.guest})
    assert sum(held.values()) == len(rows) and max(held.values()) < 150 and set(guests.values()) == {1} and set(guests) == set(held)
    got = collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprint.edited_fingerprints(docs, parts=16).collect())
    hashed = [tuple(r) for r in docs.select("doc_id", "text", F.shiftrightunsigned(F.xxhash64("text"), 11)).collect()]
    order = sorted(hashed, key=lambda r: (2**63 if r[0] is None else r[0], r[2]))
    want = collections.Counter()
    for (i, text, _), (_, after, _) in zip(order, order[1:] + order[:1], strict=True):
        n = len(text) // 4
        want[i, len(text), hashlib.sha256((text[:len(text) - n] + after[:n]).encode()).hexdigest()] += 1
    assert got == want


def test_fingerprints_of_awkward_rows(spark):
    rows = fingerprint.edited_fingerprints(awkward(spark), parts=3).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in awkward(spark).collect())
    one = fingerprint.edited_fingerprints(documents(spark, [(1, "a b c d e f")]), parts=2).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert len(fingerprint.edited_fingerprints(documents(spark, [(None, "x"), (None, "y")]), parts=2).collect()) == 2
    assert fingerprint.edited_fingerprints(empty(spark)).count() == 0
    assert fingerprint.fingerprints(awkward(spark)).count() == 14 and fingerprint.fingerprints(empty(spark)).count() == 0


def test_sketches_merge_and_estimate():
    rng = random.Random(2)
    texts = [words(rng, 2000), words(rng, 900)]
    a, b = fingerprint.sketches(texts)
    parts = fingerprint.sketches([texts[0]])[0]
    assert (fingerprint.merge([parts, a]) == a).all()
    both = fingerprint.sketches([texts[0] + "\n" + texts[1]])[0]
    assert fingerprint.containment(a, both) == fingerprint.containment(b, both) == 1.0
    assert fingerprint.containment(both, a) == pytest.approx(0.69, abs=0.15)
    assert fingerprint.distinct_count(a) == pytest.approx(1996, rel=0.35)
    assert fingerprint.resemblance(a, both) == pytest.approx(0.69, abs=0.15)
    assert (fingerprint.from_text(fingerprint.to_text(a)) == a).all()

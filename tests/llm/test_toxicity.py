"""Toxicity: features and label model against plain definitions, the whole against held-out labels."""

import itertools
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from conftest import SF01
from llm_cases import awkward, empty

from fundlake.llm import queries, toxicity
from fundlake.llm.common import table

SF1 = "/root/testdata/sf0.1"



def plain_words(text: str) -> list[bytes]:
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode())


def test_features_are_words_and_their_beginnings():
    rng = random.Random(1)
    texts = ["", "...", "ab", "Abcdef abcdeF, x"] + ["".join(rng.choice("aB c.é\n1") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    names: dict[int, tuple] = {}
    for first, n, text, hashes, kinds, _ in toxicity.present(pa.array(texts)):
        got = [[] for _ in range(n)]
        for t, h, k in zip(text.tolist(), hashes.tolist(), kinds.tolist(), strict=True):
            got[t].append((k, h))
        for t in range(n):
            words = plain_words(texts[first + t])
            want = [(0, w) for w in words] + [(k, w[:n]) for k, n in enumerate(toxicity.PREFIXES, 1) for w in words if len(w) >= n]
            assert [k for k, _ in sorted(got[t])] == [k for k, _ in sorted(want)]
            for k in range(1 + len(toxicity.PREFIXES)):
                for (_, h), (_, w) in zip([g for g in got[t] if g[0] == k], [x for x in want if x[0] == k], strict=True):
                    assert names.setdefault(h, (k, w)) == (k, w)
    assert len(set(names.values())) == len(names)


def test_dense_beginnings_lie_in_one_stretch():
    rng = random.Random(9)
    texts = [[rng.choice(["abcdx", "abcdy", "abcd", "efghi", "efghj", "q"]) if rng.random() < 0.03 else "w" for _ in range(600)] for _ in range(20)]
    joined = pa.array([" ".join(t) for t in texts])
    (_, n, text, hashes, kinds, word), = toxicity.present(joined)
    four = np.flatnonzero(kinds == 1)
    rows = four[toxicity.dense(text[four], hashes[four], word[four], hashes[word[four]], toxicity.first_words(text, kinds, n))]
    want = {(i, p) for i, t in enumerate(texts) for a in range(0, 600, toxicity.STRETCH) for p in ("abcd", "efgh")
            if len({w for w in t[a:a + toxicity.STRETCH] if w[:4] == p}) > 1}
    flat = [w for t in texts for w in t]
    assert sorted((t, flat[w][:4]) for t, w in zip(text[rows].tolist(), word[rows].tolist(), strict=True)) == sorted(want) and want


def test_votes_of_lexicons_and_patterns():
    net, _ = toxicity.build_table([], np.empty(0))
    bits, _ = toxicity.votes(net, pa.array(["", None, "You are an IDIOT!", "nice day", "go to hell", "LOUD ANGRY WORDS HERE !", "widerlich, moron"]))
    fired = [{v for i, v in enumerate(toxicity.VOTERS) if b >> i & 1} for b in bits.tolist()]
    assert fired == [set(), set(), {"nouns", "at_reader"}, set(), {"threat"}, {"shouting"}, {"nouns", "other_languages", "several"}]


def test_label_model_recovers_accuracies_and_a_correlated_pair():
    rng = np.random.default_rng(2)
    m = len(toxicity.VOTERS)
    y = (rng.random(60_000) < 0.2).astype(int)
    rates = np.stack([rng.uniform(0.02, 0.1, m), rng.uniform(0.5, 0.9, m)])
    votes = (rng.random((len(y), m)) < rates[y]).astype(int)
    votes[:, 5] = np.where(rng.random(len(y)) < 0.9, votes[:, 3], votes[:, 5])  # voter 5 mostly repeats voter 3
    patterns = votes @ (1 << np.arange(m))
    every, at = np.unique(patterns, return_inverse=True)
    anchor = np.arange(len(y)) < 1000
    clean, toxic = (np.bincount(at[anchor & (y == c)], minlength=len(every)).astype(float) for c in (0, 1))
    model = toxicity.fit_label_model(toxicity.vote_matrix(every), np.bincount(at[~anchor], minlength=len(every)).astype(float), clean, toxic)
    assert model.parent[5] == 3 or model.parent[3] == 5
    q = model.posterior(toxicity.vote_matrix(every))[at]
    assert abs(q.mean() - 0.2) < 0.02 and ((q > 0.5) == y).mean() > 0.99
    free = [j for j in range(m) if j not in (3, 5)]
    fires = np.array([[(w @ toxicity.vote_matrix(every)[:, j]) / w.sum() for j in free]
                      for w in (np.bincount(at, 1 - q), np.bincount(at, q))])
    assert np.abs(fires - rates[:, free]).max() < 0.03


def test_posterior_is_bayes_over_the_tree():
    rng = np.random.default_rng(3)
    m = len(toxicity.VOTERS)
    parent = np.array([-1, 0, 1, 1, 0, 2, 3, 3, 6, 0, 9, 10])
    model = toxicity.LabelModel(0.3, parent, rng.uniform(0.1, 0.9, (2, m, 2)))
    matrix = toxicity.vote_matrix(rng.integers(0, 1 << m, 50))
    for row, got in zip(matrix, model.posterior(matrix), strict=True):
        joint = [0.7, 0.3]
        for y, j in itertools.product((0, 1), range(m)):
            chance = model.fires[y, j, row[parent[j]] if parent[j] >= 0 else 0]
            joint[y] *= chance if row[j] else 1 - chance
        assert abs(got - joint[1] / sum(joint)) < 1e-9


def test_regression_reaches_the_least_loss():
    rng = np.random.default_rng(4)
    x = (rng.random((400, 3)) < 0.4).astype(int)
    votes = np.zeros((400, len(toxicity.VOTERS)), int)
    target = 1 / (1 + np.exp(-(x @ np.array([2.0, 0.0, 3.0]) - 2.5)))
    weights, offset = toxicity.train(np.nonzero(x), votes, 3, target, rounds=3000, penalty=0)
    assert np.allclose(weights[:3], [2, 0, 3], atol=0.05) and abs(offset + 2.5) < 0.05 and (weights >= 0).all()


def test_near_copies_count_once():
    rng = random.Random(5)
    texts = [" ".join(str(rng.random()) for _ in range(60)) for _ in range(5)]
    assert toxicity.first_of_copies([texts[0], texts[1], texts[0] + " more", texts[0], "", "", texts[2]]).tolist() == [True, True, False, False, True, True, True]


def test_held_out_labels(spark):
    docs, labels = table(spark, SF1, "documents"), table(spark, SF1, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic) and sum(r.predicted for r in clean) <= 0.005 * len(clean)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 and r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = (toxicity.fit(docs, x) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and one.offset == two.offset


def test_awkward_rows_labels_and_empty_tables(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(1, None), (4, 0), (4, 1), (None, 1), (6, 7), (10, 0)], "doc_id long, toxic int")
    for labels in (none, odd):
        net = toxicity.fit(docs, labels)
        rows = toxicity.score(docs, net).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score(empty(spark), net).collect() == []
    nothing = toxicity.fit(empty(spark), none)
    assert {r.score for r in toxicity.score(docs.where("text = ''"), nothing).collect()} == {0.5}


def test_query_scores_every_document(spark):
    out = queries.op13_toxicity(spark, SF01)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == table(spark, SF01, "documents").count()

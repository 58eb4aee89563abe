"""Shingles, suffix arrays and components against plain definitions."""

import random
import re

import numpy as np
import pytest

from fundlake.llm import components, shingles, suffix_array
from fundlake.llm.common import blocks, free_names, utf8_buffers


def plain_shingles(text: str) -> set:
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_shingle_sets_have_the_sizes_of_word_sets():
    rng = random.Random(1)
    texts = ["", " ", "a", "A a A a A a", "é É x y z w"] + ["".join(rng.choice("aB c\n\té") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    coded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
    found = shingles.shingle_sets(np.frombuffer(b"".join(coded), np.uint8), offsets)
    plain = [plain_shingles(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in plain]
    for i in range(0, len(texts) - 1, 7):
        assert len(np.intersect1d(found[i], found[i + 1])) == len(plain[i] & plain[i + 1])


def test_suffix_array_sorts_and_measures():
    rng = random.Random(2)
    for _ in range(120):
        top = rng.choice([1, 2, 26])
        s = np.array([rng.randint(0, top) for _ in range(rng.randint(1, 150))], np.uint16)
        word = suffix_array.words(s)
        order = suffix_array.suffix_array(s, word, 500)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        padded = s.tolist() + [0] * 60
        for got, a, b in zip(suffix_array.common_prefixes(word, order, 50), order[:-1], order[1:], strict=True):
            k = 0
            while k < 50 and (padded[a + k] if a + k < len(padded) else 0) == (padded[b + k] if b + k < len(padded) else 0):
                k += 1
            assert got == k


@pytest.mark.parametrize("links", [
    [(1, 2)], [(i, i + 1) for i in range(40)], [(5, i) for i in range(30) if i != 5], [(1, 2), (3, 4), (2, 3), (9, 8), (7, 9)],
])
def test_components_reach_the_smallest_node(spark, links):
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert found == root


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_helpers(spark):
    import pyarrow as pa
    data, offsets = utf8_buffers(pa.array(["ab", None, "", "cdé"]).slice(1))
    assert data.tobytes() == "cdé".encode() and offsets.tolist() == [0, 0, 0, 4]
    assert list(blocks(np.array([0, 5, 5, 30, 31]), 6)) == [(0, 2), (2, 3), (3, 4)]
    assert free_names(spark.range(1).withColumnRenamed("id", "X"), "x", "y", "y") == ["x_", "y", "y_"]


def test_links_within_a_component_are_read_once(spark, monkeypatch):
    rng = random.Random(3)
    links = [(1_000 * k + rng.randrange(300, 400), 1_000 * k + rng.randrange(30)) for k in range(3) for _ in range(1_500)]
    frame = spark.createDataFrame(links, "a long, b long")
    made, join = [], type(frame).join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if on == "b":
            made.append(out.count())
        return out

    monkeypatch.setattr(type(frame), "join", counted)
    found = {r.node: r.component for r in components.components(frame).collect()}
    both = len({*links, *((b, a) for a, b in links)})
    assert len(made) > 1 and sum(made) < 1.5 * both  # once, and few more where components were not yet joined
    assert found == {n: min(m for link in links for m in link if m // 1_000 == n // 1_000) for link in links for n in link}

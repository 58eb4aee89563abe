"""Operators that judge each row: personal data, quality, urls, packing, mixing."""

import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import awkward, documents, empty, words

from fundlake.llm import mixing, packing, pii, quality, queries, url_filter
from fundlake.llm.queries import tokenizer_path

# personal data


def plain_spans(text: str) -> dict:
    def digits(s):
        return re.sub("[^0-9]", "", s)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    return {"email": [m.span() for m in email.finditer(text)], "ip": [m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
            "card": [m.span() for m in card.finditer(text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))],
            "phone": [m.span() for m in phone.finditer(text) if 9 <= len(digits(m[0])) <= 15]}


def test_plain_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["a", "b.", "@", "1", "23", ".", " ", "-", "+", "4111111111111111", "(", ")", "x@y.z", "1.2.3.4", "é", "255", "@", "00255"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.find(text) == plain_spans(text), text


@pytest.mark.parametrize("text, kind, source", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("jane at example dot co dot uk please", "email", "jane at example dot co dot uk"),
    ("jane dot roe at example dot com", "email", "jane dot roe at example dot com"),
    ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("hsr.29 at mail5.example.com end", "email", "hsr.29 at mail5.example.com"),
    ("hsr.29_at_mail5_dot_example_dot_com", "email", "hsr.29_at_mail5_dot_example_dot_com"),
    ("HSR.29 {AT} MAIL5 (DOT) EXAMPLE.COM", "email", "HSR.29 {AT} MAIL5 (DOT) EXAMPLE.COM"),
    ("plus one (nine eight eight) five five five two four eight five ok", "phone", "plus one (nine eight eight) five five five two four eight five"),
    ("card 4532 O151 1283 O366 x", "card", "4532 O151 1283 O366"),
    ("mail john @ example dot com now", "email", "john @ example dot com"),
    ("jane dot roe @ example dot com", "email", "jane dot roe @ example dot com"),
    ("is jane99 AT example.org ok", "email", "jane99 AT example.org"),
    ("john_doe At example.com.", "email", "john_doe At example.com"),
    ("jo at " + " dot ".join("abcdefgh" * 60) + " dot com", "email", "jo at " + " dot ".join("abcdefgh" * 60) + " dot com"),
    ("a" * 90 + "7 at example.com", "email", "a" * 90 + "7 at example.com"),
    ("jo at " + "a" * 80 + " dot com", "email", "jo at " + "a" * 80 + " dot com"),
    ("j\u043ehn@ex\u0430mple.com cyr", "email", "j\u043ehn@ex\u0430mple.com"),
    ("x\u200b@foo.bar", "email", "x\u200b@foo.bar"),
    ("ip one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("\uff14\uff11\uff11\uff11 \uff11\uff11\uff11\uff11 \uff11\uff11\uff11\uff11 \uff11\uff11\uff11\uff11", "card", None),
])
def test_disguises_map_back_to_the_source(text, kind, source):
    plain, every = pii.spans(text)
    assert not plain[kind]
    assert [text[a:b] for a, b in every[kind]] == [source or text]


@pytest.mark.parametrize("ip", [
    "192 dot 168 dot 0 dot 1", "10_dot_0_dot_0_dot_1", "10-DOT-0-dot-0-dot-1", "one nine two dot 168 dot 0 dot 1", "192 dot one six eight dot zero dot one",
    "192.168 dot 0 dot 1", "192 dot 168 dot 0 dot one", "one nine two dot one six eight dot 0 dot 1", "one_nine_two_dot_168_dot_0_dot_1"])
def test_written_dots_of_addresses(ip):
    for before, after in (("", ""), ("host ", " is up"), ("5 ", "."), ("(", ")")):
        text = before + ip + after
        plain, every = pii.spans(text)
        assert not plain["ip"] and [text[a:b] for a, b in every["ip"]] == [ip], text


@pytest.mark.parametrize("text, kind", [
    ("j\u03b1ne@ex\u03b1mple.com", "email"), ("\u03c1\u03b1\u03c5l@\u03ba\u03c1\u03c4.com", "email"), ("\U0001d41aa\U0001d6fc@b.\U0001d5bcom", "email"),
    ("\u04cfee\u04c0@x.com", "email"), ("o\ufb03ce@x.com", "email"), ("\u24d0b@x.com", "email"), ("\u0967\u0966.0.0.\U0001d7cf", "ip"),
    ("\U0001d7d2111 1111 1111 \u0e51111", "card")])
def test_more_lookalikes_map_back_to_the_source(text, kind):
    assert [(0, len(text))] == [s for s in pii.spans(text)[1][kind] if s == (0, len(text))]
    assert pii.spans(f"to {text} \u00b2")[1][kind][0][0] == 3


def test_long_chains_of_written_dots_are_one_address():
    address = " dot ".join(["john", *"abcdef" * 20, "z"]) + "@example.com"
    text = f"x {address} y"
    plain, every = pii.spans(text)
    assert [text[a:b] for a, b in plain["email"]] == ["z@example.com"]
    assert [text[a:b] for a, b in every["email"]] == [address, "z@example.com"]


def test_written_dots_of_other_numbers_stay():
    for text in ("192 dot 168 dot 0", "999 dot 1 dot 1 dot 1", "1192 dot 168 dot 0 dot 1", "192 dot 168 dot 0 dot 1234", "someone dot one dot two dot three",
                 "at 3 dot 5 and 2 dot 1 dot"):
        assert not pii.spans(text)[1]["ip"], text
    pii.spans("1 dot " * 50_000), pii.spans("one dot " * 50_000)


def test_clean_texts_get_no_spans():
    for text in ("he was at home dot", "we met at one or two places", "a [note] (at) the end", "stand at ease. dot com boom",
                 "we met at example.com", "version 2.0 at noon.", "the illOIl lOll", "sections three, four, five, six", "a look-at-me dot com", ""):
        assert not any(pii.spans(text)[1].values()), text


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "1.1." * 50_000, "a@" * 100_000, "one " * 50_000, "0" * 5000 + ".0.0.0", "a dot " * 50_000, "a dot " * 50_000 + "b@c.de",
                 "x@" + "a dot " * 50_000 + "b", "a at " * 50_000, "a at b dot " * 30_000, "a" * 200_000 + " at b.cd", "a @ " * 60_000, "a_" * 60_000 + " at x.de",
                 "a-at-" * 40_000 + "b-dot-c", "x at " + "a." * 100_000, "b at c." * 40_000):
        pii.spans(text)
    assert pii.find("0" * 5000 + ".0.0.0")["ip"]


def test_find_pii(spark):
    rows = pii.find_pii(awkward(spark)).collect()
    assert len(rows) == 14 and sum(r.n_email for r in rows) == 1
    assert [r.spans for r in rows if r.doc_id == 10] == ["email:5:11"] or [r.spans for r in rows if r.doc_id == 10] == ["email:5:13"]
    assert pii.find_pii(empty(spark)).count() == 0
    assert pii.masked("to a@b.cd!") == "to ██████!"


# quality


def marked(spark, rng, n):
    good = [(2 * i, words(rng, rng.randint(3, 60))) for i in range(n)]
    junk = [(2 * i + 1, " ".join(w + "$$$" for w in words(rng, rng.randint(3, 60)).split())) for i in range(n)]
    docs = documents(spark, good + junk)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk], "doc_id long, quality int")
    return docs, labels


def test_quality_tells_junk_on_held_out_rows(spark):
    docs, labels = marked(spark, random.Random(3), 250)
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    held = [r for r in scored if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)


def test_probabilities_equal_a_plain_loop():
    """Chunks, places, filters, pooling and combination spelled out one by one."""
    rng = np.random.default_rng(21)
    net = quality.Network(rng.normal(size=(quality.SYMBOLS, quality.DIM)).astype(np.float32), rng.normal(0, 0.2, (quality.WIDTH * quality.DIM, quality.FILTERS)).astype(np.float32),
                          rng.normal(size=quality.FILTERS).astype(np.float32), rng.normal(size=2 * quality.FILTERS).astype(np.float32), 0.3)
    net.embed[quality._PAD] = 0
    texts = [b"", b"ab", bytes(rng.integers(97, 105, 511).astype(np.uint8)), bytes(rng.integers(97, 105, 513).astype(np.uint8)), bytes(rng.integers(97, 122, 1500).astype(np.uint8))]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    marked = quality.symbols(data, offsets)
    for t, got in enumerate(quality.probabilities(net, data, offsets)):
        own = marked[offsets[t]:offsets[t + 1]].tolist()
        answers, a = [], 0
        while own and (a == 0 or a + quality.CHUNK - quality.STEP < len(own)):
            chunk = (own[a:a + quality.CHUNK] + [quality._PAD] * quality.CHUNK)[:quality.CHUNK]
            best = np.max([net.embed[chunk[p:p + quality.WIDTH]].ravel() @ net.filters for p in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)], axis=0)
            answers.append(np.maximum(best + net.bias, 0))
            a += quality.STEP
        features = np.concatenate([np.mean(answers, axis=0), np.max(answers, axis=0)]) if answers else np.zeros(2 * quality.FILTERS)
        assert got == pytest.approx(1 / (1 + np.exp(-(features @ net.weights + net.offset))), abs=1e-4)


def test_quality_fit_takes_repeated_rows_once(spark):
    texts = [(i, f"good words of text {i} go on here", 1) for i in range(0, 40) if zlib.crc32(str(i).encode()) % 4 != 2]
    texts += [(100 + i, "### $$$ %%% " * (2 + i % 5), 0) for i in range(40) if zlib.crc32(str(100 + i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(i, q) for i, _, q in texts], "doc_id long, quality int")
    one = quality.fit(documents(spark, [(i, t) for i, t, _ in texts]), labels)
    many = quality.fit(documents(spark, [(i, t) for i, t, _ in texts] + [texts[0][:2]] * 3000), labels.unionByName(labels))
    assert np.array_equal(one.embed, many.embed) and one.offset == many.offset


def test_quality_of_awkward_rows(spark):
    net = quality.Network.constant(0.8)
    assert {r.score for r in quality.score(awkward(spark), net).collect()} == {0.8}
    kept = quality.keep_good(awkward(spark), net)
    assert kept.count() == 14 and kept.columns == awkward(spark).columns
    assert quality.keep_good(awkward(spark), quality.Network.constant(0.2)).count() == 0
    assert quality.score(empty(spark), net).count() == 0
    nothing = quality.fit(empty(spark), spark.createDataFrame([(1, None)], "doc_id long, quality int"))
    assert quality.probabilities(nothing, np.empty(0, np.uint8), np.array([0, 0])).tolist() == pytest.approx([0.5])


def test_chunks_cover_every_byte_and_filter_place():
    for n in (0, 1, 7, 480, 511, 512, 513, 992, 993, 5000):
        begin, end, first = quality.layout(np.array([3, 3 + n]))
        assert len(begin) == first[-1] and (n == 0) == (len(begin) == 0) and set(end.tolist()) <= {3 + n}
        places = [p for b in begin.tolist() for p in range(b, b + quality.CHUNK) if p < 3 + n]
        assert set(places) == set(range(3, 3 + n))
        assert quality.CHUNK - quality.STEP >= quality.WIDTH


def test_repetition_is_marked_within_texts_only():
    texts = [b"reen reen reen", b"reen", b"abcabcabcabc", b"no such thing"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    marks = quality.symbols(np.frombuffer(b"".join(texts), np.uint8), offsets) >= 256
    parts = [marks[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert parts[0].tolist() == [False] * 8 + [True] * 6 and not parts[1].any() and not parts[3].any()
    assert parts[2].tolist() == [False] * 6 + [True] * 6


def test_scores_do_not_depend_on_neighbours():
    rng = random.Random(5)
    texts = [words(rng, rng.randint(1, 300)).encode() for _ in range(30)]
    net = quality.train(texts, np.arange(30) % 2, epochs=1)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = quality.probabilities(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    alone = [quality.probabilities(net, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-5)


# urls


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest)[0][len(host):]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "https://a.Example.com/en/x?y=/fr/", "https://www.example.com/en/1", "http://x.net/es/",
            "http://x.net?/es/", "http://net/fr/#z", "http://xnet/fr/", "ftp://a.com", "http://a.com/://b.net/es/", "http://éa.net/es/ü", "a://b://c.com/"]
    rules = [*url_filter.RULES, *((f"h{i}.org", f"/p{i}/", "block") for i in range(300))]
    urls += [f"http://s{i % 7}.h{i}.org/p{i % 310}/q" for i in range(600)]
    rows = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    for rate in (0.5, 0.05):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(rows, rules, first_rate=rate).collect()}
        assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_cascade_is_exact_over_its_universe(spark):
    rules = [(f"h{i}.org", "/", "block") for i in range(200)]
    urls = spark.createDataFrame([(f"h{i}.org", "/") for i in range(3000)], "host string, path string")
    cascade = url_filter.build_cascade(urls, rules, first_rate=0.3)
    assert len(cascade.levels) > 2
    keys = [url_filter.key_of(f"h{i}.org", "/") for i in range(3000)]
    assert cascade.listed(keys).tolist() == [i < 200 for i in range(3000)]
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_rules_of_equal_length_and_repeated_ones(spark):
    rules = [("b.com", "/x/", "block"), ("com", "/x/y/", "allow"), ("twice.org", "/", "allow"), ("twice.org", "/", "block"), ("third.org", "/", "review")]
    urls = ["http://b.com/x/y/z", "http://a.b.com/x/y/", "http://b.com/x/q", "http://c.com/x/y/", "http://twice.org/", "http://third.org/a"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(rows, rules, first_rate=0.5).collect()}
    assert got == {0: ("b.com/x/", "block"), 1: ("b.com/x/", "block"), 2: ("b.com/x/", "block"), 3: ("com/x/y/", "allow"),
                   4: ("twice.org/", "block"), 5: ("third.org/", "review")}


def test_executors_get_filters_and_no_list(spark, monkeypatch):
    """What is broadcast holds bits only: no listed host is spelled in it."""
    import pickle
    sent = []
    original = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(pickle.dumps(value)) or original(self, value))
    rules = [(f"listed{i}.org", "/", "block" if i % 3 else "allow") for i in range(2000)]
    rows = spark.createDataFrame([(i, f"http://listed{i}.org/") for i in range(0, 4000, 7)], "page_id long, url string")
    got = {r.page_id: r.rule for r in url_filter.filter_urls(rows, rules).collect()}
    assert got == {i: f"listed{i}.org/" if i < 2000 else None for i in range(0, 4000, 7)}
    assert len(sent) == 2 and not any(b"listed" in value.replace(b"url_filter", b"") for value in sent) and sum(map(len, sent)) < 20 * 2000


# packing


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer
    docs = awkward(spark)
    pieces = packing.pack(docs, tokenizer_path(), keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = sorted([str(r.doc_id), tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]] for r in docs.collect())
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    got, ids = [], []
    for p in sorted(pieces, key=lambda p: p.sequence_id):
        assert p.length & (p.length - 1) == 0 and p.length <= 2048 and p.offset == 0 and p.length == 1 << p.bucket == len(p.ids)
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.start == len(ids)
        ids += p.ids
        if len(ids) == p.doc_tokens:
            got.append([str(p.doc_id), ids])
            ids = []
    assert sorted(got) == want
    sizes = {r.bucket: (r.sequences, r.tokens) for r in packing.bucket_sizes(packing.pack(docs, tokenizer_path())).collect()}
    assert sum(n << b for b, (n, _) in sizes.items()) == sum(len(i) for _, i in want)
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def test_remembered_words_equal_the_tokenizer():
    coder = packing.WordIds(tokenizer_path())
    rng = random.Random(1)
    letters = "abzAÉéßñÑ µªº¼²'.,!?<|>0123 \t\n-_*×ÀßǄİΣ\u0301\u200b一\U0001f600\x1c\x85\xa0\xad'strevlld"
    texts = ["", "   ", "a" * 5000, "<|endoftext|> x", "É" * 300 + ".", "don't 've.", "x.'s"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for part in (texts, texts[:50]):
        assert coder.ids(part) == [coder._whole(t) for t in part]


def test_piece_lengths():
    for n in range(1, 9000, 37):
        lengths = packing.piece_lengths(n)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True) and all(x & (x - 1) == 0 for x in lengths)
    with pytest.raises(ValueError):
        packing.pack(None, "", max_length=1000)


# mixing


def test_query_reaches_its_margins(spark):
    """The expected sample of the registered query: half of the words, sources and languages at their targets."""
    rows = queries.op1_mixing(spark, "/root/testdata/sf0.1").collect()
    expected = [(r, r.words * r.probability) for r in rows]
    size = sum(v for _, v in expected)
    assert size == pytest.approx(0.5 * sum(r.words for r in rows), rel=1e-3)
    for name, targets in (("mix_source", mixing.SOURCE_TARGETS), ("mix_lang", mixing.LANG_TARGETS)):
        for category, target in targets.items():
            share = sum(v for r, v in expected if r[name] == category) / size
            assert share == pytest.approx(target / sum(targets.values()), rel=0.01), category


def test_mix_and_calibrated_agree(spark):
    docs = awkward(spark)
    rows = mixing.calibrated(docs).collect()
    assert len(rows) == 14 and all(0 <= r.probability <= 1 and r.selected == (r.u < r.probability) for r in rows)
    kept = mixing.mix(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.selected for r in rows)
    assert mixing.mix(empty(spark)).count() == 0 and mixing.calibrated(empty(spark)).count() == 0


def test_topic_takes_the_rule_that_matches_most(spark):
    from pyspark.sql import functions as F
    texts = spark.createDataFrame([("ab go zz zz",), ("ab ab go go",), ("é",), ("",), ("1 2 a",)], "text string")
    got = [r[0] for r in texts.select(mixing.topic_of(F.col("text"), mixing.TOPIC_RULES)).collect()]
    assert got == ["late", "early", "other", "other", "marked"]


def test_bounded_margins_of_the_expected_sample(spark):
    """After the bound at 1 the margins have their shares; a topic of two words is kept whole and takes nothing from its sources."""
    rng = random.Random(7)
    targets = ({"a": 0.4, "b": 0.4, "c": 0.2}, {"en": 0.6, "fr": 0.4}, {"x": 0.5, "y": 0.4, "other": 0.1})
    cells = {(s, g, t): rng.randint(300, 900) for s in "abc" for g in ("en", "fr") for t in "xy"} | {("a", "en", "other"): 1, ("b", "fr", "other"): 1}
    table = spark.createDataFrame([(*k, v) for k, v in cells.items()], "mix_source string, mix_lang string, mix_topic string, words long")
    got = {(r.mix_source, r.mix_lang, r.mix_topic): r.probability for r in mixing.bounded_fit(table, *targets, share=0.5).collect()}
    size = 0.5 * sum(cells.values())
    assert got.keys() == cells.keys() and all(0 < p <= 1 for p in got.values())
    rest = (size - 2) / size / 0.9
    for k, goals in enumerate((*targets[:2], {"x": 0.5 * rest, "y": 0.4 * rest, "other": 2 / size})):
        for name, goal in goals.items():
            assert sum(got[c] * cells[c] for c in cells if c[k] == name) / size == pytest.approx(goal, abs=1e-4), name


def test_unlisted_sources_and_languages_are_weighted(spark):
    """They keep their share of the words, alone or beside listed ones; a listed target for ``other`` holds."""
    rng = random.Random(13)
    listed = [(i, words(rng, 20), "en", f"src{i % 20}", 1) for i in range(300)]
    odd = [(1000 + i, words(rng, 20), rng.choice(["it", None, "en"]), rng.choice(["src20", None]), 1) for i in range(100)]
    for rows in (listed + odd, odd):
        got = mixing.calibrated(documents(spark, rows)).collect()
        expected = {r.doc_id: r.words * r.probability for r in got}
        share = sum(v for i, v in expected.items() if i >= 1000) / sum(expected.values())
        assert share == pytest.approx(len(odd) / len(rows), abs=1e-3) and all(r.probability > 0 for r in got)
        assert {r.doc_id for r in mixing.mix(documents(spark, rows)).collect()} == {r.doc_id for r in got if r.selected}
    none = mixing.calibrated(documents(spark, listed + odd), sources=mixing.SOURCE_TARGETS | {"other": 0.0}).collect()
    assert all((r.probability > 0) == (r.doc_id < 1000) for r in none)

"""Mixing sources to target weights by iterative proportional fitting (DataFrame and SQL functions only).

Every document counts its words.  The word counts of the cells (source,
language, topic) are raked until the expected sample has the target share of
each source, language and topic; a document is then kept with its cell's
probability, decided by a hash of its id.

Probabilities stay within 1 during the raking (``bounded_fit``): a category
that holds fewer words than its target is kept whole, and what it lacks goes to
the other categories of its margin in proportion to their targets.  Targets
that contradict each other across margins are met as nearly as the last rounds
come.

The targets are parameters and list their categories; anything else falls into
the category ``other``, whose target, unless it is listed too, is its own share
of the corpus's words: such documents are thinned like the rest, not dropped.  So the number of cells is bounded by the parameters,
not by the data, and the raking itself is one array expression over one row.

Defined cases: null source, language or topic count as ``other``; a null or
empty text has no words and topic ``other``; categories without any words drop
out and the rest of their margin is scaled to one; repeated rows get the same
decision; a null doc_id hashes as the empty string.  Empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_column, free_names, staged

OTHER = "other"

#: Default target shares: 20 sources alike, so that a hot source is thinned; four languages; four topics.
SOURCE_TARGETS = {f"src{i}": 1.0 for i in range(20)}
LANG_TARGETS = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}
TOPIC_TARGETS = {"early": 0.3, "middle": 0.25, "late": 0.25, "marked": 0.1, OTHER: 0.1}

#: Topic rules: the pattern that matches most often in a text names its topic (ties: the rule listed first).
#: Patterns are searched in the text after one blank.  Without trained topics the defaults part the vocabulary by the initials of words, and by digits and marks.
TOPIC_RULES = {
    "early": "[ \\n\\t][a-fA-F]",
    "middle": "[ \\n\\t][g-oG-O]",
    "late": "[ \\n\\t][p-zP-Z]",
    "marked": "[0-9$%&#*|!]",
}

#: Rounds of the raking; cells at probability 1 slow it down.
BOUNDED_ROUNDS = 100
SEED = "mix-1"
#: Share of the corpus's words that the expected sample has.
SAMPLE_SHARE = 0.5


def words_of(text: Column) -> Column:
    """Number of words: maximal runs without white space."""
    return F.regexp_count(text, F.lit("[^ \\t\\n\\r\\f\\x0B]+")).cast("long")


def topic_of(text: Column, rules: Mapping[str, str]) -> Column:
    """Name of the rule that matches most often; ``other`` when none does."""
    padded = F.concat(F.lit(" "), text)
    counts = F.array(*[F.regexp_count(padded, F.lit(p)) for p in rules.values()])
    names = F.array(*[F.lit(n) for n in rules])

    def best(found: Column) -> Column:
        most = F.array_max(found)
        return F.when(most > 0, F.get(names, (F.array_position(found, most) - 1).cast("int"))).otherwise(F.lit(OTHER))

    # as a lambda's variable the counts are taken once, however often the choice looks at them
    return F.get(F.transform(F.array(counts), best), F.lit(0))


def category(value: Column, targets: Mapping[str, float]) -> Column:
    return F.when(value.isin(*[k for k in targets if k != OTHER]), value).otherwise(F.lit(OTHER))


def unit(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the id: the first 32 bits of an MD5."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def features(docs: DataFrame, rules: Mapping[str, str], sources: Mapping[str, float], langs: Mapping[str, float]) -> list[Column]:
    text = F.coalesce(as_column("text"), F.lit(""))
    return [category(as_column("source"), sources).alias("mix_source"), category(as_column("lang"), langs).alias("mix_lang"),
            topic_of(text, rules).alias("mix_topic"), words_of(text).alias("words")]


def _shares(targets: Mapping[str, float]) -> tuple[list[str], list[float]]:
    names = [k for k in targets if k != OTHER] + [OTHER]
    return names, [float(targets.get(k, 0.0)) for k in names]


def _listed(names: list[str]) -> str:
    return "array(" + ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names) + ")"


def _numbers(values: list[float]) -> str:
    return "array(" + ", ".join(f"{v!r}D" for v in values) + ")"


def _dense(cells: DataFrame, s: list[str], g: list[str], t: list[str]) -> DataFrame:
    """One row with ``w``: the words of all cells in the order source, language, topic."""
    ng, nt = len(g), len(t)
    cube = cells.agg(F.expr("map_from_entries(collect_list(struct(concat_ws('|', "
                            f"array_position({_listed(s)}, mix_source) - 1, array_position({_listed(g)}, mix_lang) - 1, "
                            f"array_position({_listed(t)}, mix_topic) - 1) as k, cast(words as double) as w)))").alias("m"))
    return cube.select(F.expr(
        f"transform(sequence(0, {len(s) * ng * nt - 1}), i -> coalesce(m[concat_ws('|', i div {ng * nt}, (i div {nt}) % {ng}, i % {nt})], 0D))"
    ).alias("w"))


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def bounded_fit(cells: DataFrame, sources: Mapping[str, float], langs: Mapping[str, float], topics: Mapping[str, float],
                share: float = SAMPLE_SHARE, rounds: int = BOUNDED_ROUNDS) -> DataFrame:
    """(mix_source, mix_lang, mix_topic, words, probability) of every cell, raked with no probability above 1.

    Every category's goal is a number of expected words: its target share of
    the sample, or all its words if it holds fewer, the rest of the margin
    sharing what is left.  Each round scales the expected words of one margin
    after the other to the goals and holds every cell at its own words.
    """
    margins = [_shares(m) for m in (sources, langs, topics)]
    sizes = [len(names) for names, _ in margins]
    ns, ng, nt = sizes
    cells_n = ns * ng * nt
    #: category of cell i; cell of the j-th member of category c; members of a category
    of = [f"cast(i div {ng * nt} as int)", f"cast((i div {nt}) % {ng} as int)", f"cast(i % {nt} as int)"]
    member = [f"c * {ng * nt} + j", f"(j div {nt}) * {ng * nt} + c * {nt} + j % {nt}", f"j * {nt} + c"]

    def total(array: str) -> str:
        return f"aggregate({array}, 0D, (a, v) -> a + v)"

    def sums(k: int, array: str) -> str:
        return (f"transform(sequence(0, {sizes[k] - 1}), c -> aggregate(sequence(0, {cells_n // sizes[k] - 1}), 0D, "
                f"(a, j) -> a + get({array}, cast({member[k]} as int))))")

    def target(k: int) -> str:
        """Target shares; an ``other`` that is not listed has its share of the corpus and the listed categories the rest."""
        given = _numbers(margins[k][1])
        if OTHER in (sources, langs, topics)[k]:
            return given
        listed = f"aggregate(zip_with(own, {given}, (v, t) -> if(v > 0, t, 0D)), 0D, (a, v) -> a + v)"
        rest = f"coalesce(try_divide((1D - other) * t, {listed}), 0D)"
        return _let("own", sums(k, "w"), _let("other", f"coalesce(try_divide(get(own, {sizes[k] - 1}), {total('own')}), 0D)",
                    f"transform({given}, (t, c) -> if(c = {sizes[k] - 1}, other, {rest}))"))

    def words_of_goals(k: int) -> str:
        """Goals in words: least(words, level * target), at the level where they add up to the sample."""
        level = (f"aggregate(sequence(0, {sizes[k]}), 0D, (l, r) -> coalesce(try_divide("
                 f"size - aggregate(zip_with(held, t{k}, (h, t) -> if(h <= l * t, h, 0D)), 0D, (a, v) -> a + v), "
                 f"aggregate(zip_with(held, t{k}, (h, t) -> if(h <= l * t, 0D, t)), 0D, (a, v) -> a + v)), l))")
        return _let("held", sums(k, "live"), _let("level", level, f"zip_with(held, t{k}, (h, t) -> least(h, level * t))"))

    def step(k: int) -> str:
        factors = f"zip_with({sums(k, 'x')}, goal{k}, (v, goal) -> if(v > 0, goal / v, 0D))"
        return _let("factors", factors, f"transform(x, (v, i) -> least(get(live, i), v * get(factors, {of[k]})))")

    x = (f"aggregate(sequence(1, {int(rounds)}), transform(live, v -> coalesce(v * try_divide(size, {total('live')}), 0D)), (y, r) -> "
         f"aggregate(array(0, 1, 2), y, (x, m) -> case m when 0 then {step(0)} when 1 then {step(1)} else {step(2)} end))")
    for k in (2, 1, 0):
        x = _let(f"goal{k}", words_of_goals(k), x)
    x = _let("size", f"least({float(share)!r}D * {total('w')}, {total('live')})", x)
    x = _let("live", f"transform(w, (v, i) -> if(get(t0, {of[0]}) > 0 and get(t1, {of[1]}) > 0 and get(t2, {of[2]}) > 0, v, 0D))", x)
    for k in (2, 1, 0):
        x = _let(f"t{k}", target(k), x)
    (s, _), (g, _), (t, _) = margins
    return _dense(cells, s, g, t).select("w", F.expr(x).alias("x")).select(F.expr(
        f"inline(transform(arrays_zip(w, x), (v, i) -> named_struct('mix_source', get({_listed(s)}, {of[0]}), "
        f"'mix_lang', get({_listed(g)}, {of[1]}), 'mix_topic', get({_listed(t)}, {of[2]}), 'words', v.w, "
        f"'probability', coalesce(round(least(1D, try_divide(v.x, v.w)), 9), 0D))))")).where("words > 0")


def calibrated(docs: DataFrame, sources: Mapping[str, float] = SOURCE_TARGETS, langs: Mapping[str, float] = LANG_TARGETS,
               topics: Mapping[str, float] = TOPIC_TARGETS, rules: Mapping[str, str] = TOPIC_RULES,
               share: float = SAMPLE_SHARE, seed: str = SEED, rounds: int = BOUNDED_ROUNDS) -> DataFrame:
    """One row per document: doc_id, mix_source, mix_lang, mix_topic, words, probability, u and ``selected``.

    The features are computed once and staged without the text; the cells are
    bounded by the targets, so their table is broadcast.
    """
    own = staged(docs.select(as_column("doc_id"), *features(docs, rules, sources, langs)), "mix-features")
    cells = own.groupBy("mix_source", "mix_lang", "mix_topic").agg(F.sum("words").alias("words"))
    table = bounded_fit(cells, sources, langs, topics, share, rounds)
    out = own.join(F.broadcast(table.select("mix_source", "mix_lang", "mix_topic", "probability")), ["mix_source", "mix_lang", "mix_topic"], "left")
    probability = F.coalesce("probability", F.lit(0.0))
    return (out.withColumn("probability", probability).withColumn("u", unit(F.col("doc_id"), seed))
            .withColumn("selected", F.col("u") < F.col("probability"))
            .select("doc_id", "mix_source", "mix_lang", "mix_topic", "words", "probability", "u", "selected"))


def mix(docs: DataFrame, sources: Mapping[str, float] = SOURCE_TARGETS, langs: Mapping[str, float] = LANG_TARGETS,
        topics: Mapping[str, float] = TOPIC_TARGETS, rules: Mapping[str, str] = TOPIC_RULES,
        share: float = SAMPLE_SHARE, seed: str = SEED, rounds: int = BOUNDED_ROUNDS) -> DataFrame:
    """The sampled rows of ``docs``, all columns kept.  The decisions of ``calibrated`` without a join on ids."""
    s, g, t, w, p = free_names(docs, "mix_source", "mix_lang", "mix_topic", "mix_words", "mix_probability")
    cols = features(docs, rules, sources, langs)
    cells = (docs.select(*cols).groupBy("mix_source", "mix_lang", "mix_topic").agg(F.sum("words").alias("words")))
    table = bounded_fit(staged(cells, "mix-cells"), sources, langs, topics, share, rounds)
    table = F.broadcast(table.select(F.col("mix_source").alias(s), F.col("mix_lang").alias(g), F.col("mix_topic").alias(t), F.col("probability").alias(p)))
    named = docs.select(*[as_column(c) for c in docs.columns], *[c.alias(n) for c, n in zip(cols[:3], (s, g, t), strict=True)])
    # a left join that stays one: an inner join would evaluate the topics again to test them for null
    return named.join(table, [s, g, t], "left").where(unit(as_column("doc_id"), seed) < F.coalesce(p, F.lit(0.0))).select(*[as_column(c) for c in docs.columns])


def _oracle() -> str:
    """DuckDB SQL for ``calibrated`` with the default parameters: goals by recursion over levels, raking by recursion over window sums."""
    margins = {"s": SOURCE_TARGETS, "g": LANG_TARGETS, "t": TOPIC_TARGETS}

    def listed(targets: Mapping[str, float]) -> str:
        return ", ".join(f"'{n}'" for n in targets if n != OTHER)

    counts = ", ".join(f"len(regexp_extract_all(' ' || body, '{p}'))" for p in TOPIC_RULES.values())
    names = ", ".join(f"'{n}'" for n in TOPIC_RULES)
    ctes = []
    for k, targets in margins.items():
        given, goals = _shares(targets)
        values = ", ".join(f"('{n}', {v!r}::DOUBLE)" for n, v in zip(given, goals, strict=True))
        share = "goal"
        if OTHER not in targets:
            other = f"coalesce(sum(own) FILTER (WHERE n = '{OTHER}') OVER () / sum(own) OVER (), 0)"
            share = f"CASE WHEN n = '{OTHER}' THEN {other} ELSE coalesce((1 - {other}) * goal / nullif(sum(CASE WHEN own > 0 THEN goal ELSE 0 END) OVER (), 0), 0) END"
        ctes.append(f"""named_{k}(n, goal) AS (VALUES {values}),
target_{k} AS MATERIALIZED (SELECT n, {share} AS t FROM (
  SELECT n, goal, coalesce(sum(w), 0) AS own FROM named_{k} LEFT JOIN cells ON cells.{k} = n GROUP BY n, goal))""")
    for k, targets in margins.items():
        ctes.append(f"""held_{k} AS MATERIALIZED (SELECT n, any_value(c.t) AS t, coalesce(sum(live), 0) AS h
  FROM target_{k} c LEFT JOIN alive ON alive.{k} = n GROUP BY n),
level_{k}(r, l) AS (SELECT 0, 0::DOUBLE UNION ALL
  SELECT r + 1, coalesce(((SELECT size FROM total) - (SELECT sum(CASE WHEN h <= l * t THEN h ELSE 0 END) FROM held_{k}))
    / nullif((SELECT sum(CASE WHEN h <= l * t THEN 0 ELSE t END) FROM held_{k}), 0), l) FROM level_{k} WHERE r <= {len(_shares(targets)[0])}),
goal_{k} AS MATERIALIZED (SELECT n, least(h, t * (SELECT l FROM level_{k} ORDER BY r DESC LIMIT 1)) AS goal FROM held_{k})""")
    margin_ctes = ",\n".join(ctes[:3])
    goal_ctes = ",\n".join(ctes[3:])
    return f"""
WITH RECURSIVE base AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IN ({listed(SOURCE_TARGETS)}) THEN source ELSE '{OTHER}' END AS mix_source,
    CASE WHEN lang IN ({listed(LANG_TARGETS)}) THEN lang ELSE '{OTHER}' END AS mix_lang, body,
    [{counts}] AS counts, len(regexp_extract_all(body, '[^ \t\n\r\f\x0B]+'))::BIGINT AS words
  FROM (SELECT *, coalesce(text, '') AS body FROM documents)),
own AS MATERIALIZED (
  SELECT doc_id, mix_source, mix_lang, words, CASE WHEN list_max(counts) > 0
    THEN list_extract([{names}], list_position(counts, list_max(counts))) ELSE '{OTHER}' END AS mix_topic FROM base),
cells AS MATERIALIZED (
  SELECT mix_source AS s, mix_lang AS g, mix_topic AS t, sum(words)::DOUBLE AS w FROM own GROUP BY ALL HAVING sum(words) > 0),
{margin_ctes},
alive AS MATERIALIZED (SELECT c.s, c.g, c.t, w, CASE WHEN a.t > 0 AND b.t > 0 AND d.t > 0 THEN w ELSE 0 END AS live
  FROM cells c JOIN target_s a ON c.s = a.n JOIN target_g b ON c.g = b.n JOIN target_t d ON c.t = d.n),
total AS MATERIALIZED (SELECT least({SAMPLE_SHARE!r} * sum(w), sum(live)) AS size, sum(live) AS live FROM alive),
{goal_ctes},
raked(r, s, g, t, w, live, x, goal_s, goal_g, goal_t) AS (
  SELECT 0, s, g, c.t, w, c.live, coalesce(c.live * size / nullif(total.live, 0), 0), a.goal, b.goal, d.goal
  FROM alive c, total, goal_s a, goal_g b, goal_t d WHERE a.n = s AND b.n = g AND d.n = c.t
  UNION ALL
  SELECT r + 1, s, g, t, w, live, least(live, x * coalesce(CASE r % 3 WHEN 0 THEN goal_s / nullif(sum(x) OVER (PARTITION BY s), 0)
    WHEN 1 THEN goal_g / nullif(sum(x) OVER (PARTITION BY g), 0) ELSE goal_t / nullif(sum(x) OVER (PARTITION BY t), 0) END, 0)),
    goal_s, goal_g, goal_t FROM raked WHERE r < {3 * BOUNDED_ROUNDS}),
fitted AS (SELECT s, g, t, round(least(1.0, x / w), 9) AS p FROM raked WHERE r = {3 * BOUNDED_ROUNDS}),
out AS (SELECT o.*, coalesce(p, 0.0) AS probability,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS u
  FROM own o LEFT JOIN fitted f ON o.mix_source = f.s AND o.mix_lang = f.g AND o.mix_topic = f.t)
SELECT doc_id, mix_source, mix_lang, mix_topic, words, probability, u, u < probability AS selected FROM out
"""


ORACLE_SQL = _oracle()

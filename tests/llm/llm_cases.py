"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows of (doc_id, text) or whole rows."""
    whole = [r if len(r) == 5 else (r[0], r[1], "en", "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(whole, SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty, blank and very long texts, repeated rows, repeated ids, odd characters, clashing columns."""
    rng = random.Random(4)
    long_text = "\n".join(words(rng, 40) for _ in range(150))
    rows = [
        (1, "", "en", "src0", 0), (2, None, None, None, None), (3, "   \n\t ", "en", "src1", 5), (4, long_text, "fr", "src2", len(long_text)),
        (5, long_text, "fr", None, 1), (5, long_text, "fr", None, 1), (6, "one two", "xx", "elsewhere", 7), (6, "other words", "en", "src0", 1),
        (None, "no id here", "en", "src0", 1), (None, None, "en", "src0", 1), (7, "x" * 30_000, "en", "src0", 1),
        (8, "é ß İ ſ 漢字 \U0001f600 \u200b end", "de", "src3", 3), (9, "a\x00b", "en", "src0", 3), (10, "mail a.b@c.de now", "en", "src0", 5),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ["n_removed", "N_lines", "tag", "kept", "score", "component_id", "mix_source", "start", "a.b", "near", "kept_doc"]
    for name in clash:
        df = df.withColumn(name, df["n_chars"])
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)

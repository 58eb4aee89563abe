"""Line dedup: windows of three consecutive lines that occur again are removed after their first occurrence.

A text's lines are its parts between ``\\n``.  Every run of ``width``
consecutive lines is hashed (128 bits); a window found at several places of the
corpus is kept at its first place and removed at all later ones, and a line
goes when any removed window covers it.  Places are ordered by doc_id (null
last), then text, then line number.

Defined cases: a null text counts as empty and stays null when nothing is
removed from it; texts of fewer than ``width`` lines lose nothing; rows that
repeat both doc_id and text are one document, so they do not remove each other
and get the same result; rows that share a doc_id (or have none) with different
texts are different documents.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_column, free_names, staged

WIDTH = 3


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, tag, at, h1, h2): one row per window of consecutive lines."""
    lines = docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("tag"), F.split("text", "\n", -1).alias("lines"),
    ).where(F.size("lines") >= width)
    window = ", ".join(f"lines[i + {k}]" for k in range(width))
    hashed = F.expr(f"transform(sequence(0, size(lines) - {width}), "
                    f"i -> named_struct('h1', xxhash64({window}), 'h2', xxhash64('second', {window})))")
    return lines.select("doc_id", "tag", F.posexplode(hashed).alias("at", "h")).select("doc_id", "tag", "at", "h.h1", "h.h2")


def repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, tag, starts): the windows of each document that occur earlier; ``docs`` has doc_id and text.

    The first places come from a map-side combined minimum per hash, so a
    window that a third of all documents hold stays one row per task there.
    They are staged, so the join back has plain shuffles on both sides, and
    adaptive execution splits its hot windows.
    """
    windows = _windows(docs, width)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("tag"), F.col("at"))
    first = staged(windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                   .where("first != last").select("h1", "h2", "first"), "line-first")
    later = windows.join(first, ["h1", "h2"]).where(place != F.col("first"))
    return later.groupBy("doc_id", "tag").agg(F.collect_set("at").alias("starts"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated lines removed from the text, plus ``n_lines`` and ``n_removed``.

    The two added columns get other names (a trailing underscore) when the table has them already.
    """
    n_lines, n_removed, tag, lines, starts, own, of = free_names(docs, "n_lines", "n_removed", "line_tag", "line_list", "line_starts", "line_own", "line_of")
    base = docs.select(as_column(id_col).alias("doc_id"), F.coalesce(as_column(text_col), F.lit("")).alias("text"))
    found = repeated_lines(base, width).select(F.col("doc_id").alias(of), F.col("tag").alias(tag), F.col("starts").alias(starts))
    text = F.coalesce(as_column(text_col), F.lit(""))
    joined = docs.withColumn(own, F.xxhash64(text)).join(
        found, as_column(id_col).eqNullSafe(F.col(of)) & (F.col(own) == F.col(tag)), "left")
    covered = " or ".join(f"array_contains({starts}, i - {k})" for k in range(width))
    kept = F.expr(f"filter({lines}, (x, i) -> not ({covered}))")
    split = joined.withColumn(lines, F.split(text, "\n", -1))
    out = [F.when(F.col(starts).isNull(), as_column(c)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col
           else as_column(c) for c in docs.columns]
    removed = F.when(F.col(starts).isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept))
    return split.select(*out, F.size(lines).cast("long").alias(n_lines), removed.cast("long").alias(n_removed))


ORACLE_SQL = """
WITH base AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(lines) - 1)) AS pos, lines FROM base WHERE len(lines) >= 3),
hashed AS (
  SELECT doc_id, pos, md5(lines[pos] || chr(10) || lines[pos + 1] || chr(10) || lines[pos + 2]) AS h FROM win),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) AS rn FROM hashed),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS line FROM ranked WHERE rn > 1),
every AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS line, unnest(lines) AS body FROM base),
kept AS (
  SELECT e.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
         coalesce(string_agg(e.body, chr(10) ORDER BY e.line) FILTER (WHERE g.line IS NULL), '') AS kept_text
  FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.line = g.line GROUP BY e.doc_id)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, kept_text FROM kept
"""

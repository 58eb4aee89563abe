"""Bronze files as they are: listing, landing ledger, header layouts, schema drift.

Drops of different dates, or of different producers on one date, may order
their columns differently, add some or leave some out.  Files are grouped by
their header (a layout); each layout is one scan read by its own header, and
the layouts are united by column name.  So a plan grows with the number of
layouts, not of dates or files.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.functions.numeric import q
from fundlake.sources.bronze import CSV_OPTIONS, LOAD_DATE
from fundlake.sources.decode import CANDIDATES, cell_class

_FILES = "path string, load_date string, length long, modified timestamp"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, load_date, length, modified) of every CSV file below ``path``; contents are not read."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.csv").load(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _FILES)
    return files.select("path", F.regexp_extract("path", f"/{LOAD_DATE}=([^/]+)/", 1).alias(LOAD_DATE), "length",
                        F.col("modificationTime").alias("modified"))


def _folder(col):
    return F.regexp_extract(col, "^(.*)/[^/]+$", 1)


@dataclass(frozen=True)
class Layout:
    """One header, the folders whose files all have it, and files with it in folders of several headers."""

    columns: tuple[str, ...]
    folders: tuple[str, ...]
    files: tuple[str, ...]
    dates: tuple[str, ...]


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header) of every file: its first line.

    One pass over the lines of each file's first split, combined map-side to
    one row per file.  Files without a line have no header.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    first = lines.where("start = 0").withColumn("at", F.monotonically_increasing_id())
    return first.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def layouts(spark: SparkSession, paths: Sequence[str]) -> list[Layout]:
    """The layouts of the files below ``paths``, by header.

    The driver gets one row per header and folder (a date's drop), and single
    files only of folders in which headers differ.
    """
    every = headers(spark, paths).withColumn("folder", _folder("path"))
    grouped = every.groupBy("folder", "header").agg(F.collect_list("path").alias("paths"), F.min("path").alias("least"))
    mixed = F.count("*").over(Window.partitionBy("folder")) > 1
    rows = grouped.withColumn("mixed", mixed).select(
        "folder", "header", "mixed", F.when(F.col("mixed"), F.sort_array("paths")).alias("paths"),
        F.regexp_extract("least", f"/{LOAD_DATE}=([^/]+)/", 1).alias("date")).orderBy("header", "folder").collect()
    out: dict[tuple[str, ...], list] = {}
    for r in rows:
        columns = tuple(next(csv.reader([r["header"].removeprefix("﻿")])))
        folders, files, dates = out.setdefault(columns, [[], [], []])
        files.extend(r["paths"]) if r["mixed"] else folders.append(r["folder"])
        dates.append(r["date"])
    return [Layout(c, tuple(a), tuple(b), tuple(sorted(set(d)))) for c, (a, b, d) in out.items()]


def read_layouts(spark: SparkSession, found: Sequence[Layout], base: str, multiline: bool = True) -> DataFrame:
    """All rows of the layouts as text, united by column name, with ``load_date``; absent columns are NULL."""
    names = list(dict.fromkeys(c for layout in found for c in layout.columns))
    parts = []
    for layout in found:
        schema = ", ".join(f"{q(c)} STRING" for c in layout.columns)
        df = (spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower()).option("enforceSchema", "false")
              .option("basePath", base).schema(schema).csv([*layout.folders, *layout.files]))
        date = F.col(LOAD_DATE).cast("string") if LOAD_DATE in df.columns and LOAD_DATE not in layout.columns else F.lit(None).cast("string")
        parts.append(df.select(*[F.col(q(c)) if c in layout.columns else F.lit(None).cast("string").alias(c) for c in names],
                               date.alias(LOAD_DATE)))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def read_dates(spark: SparkSession, path: str, dates: Sequence[str] | None = None, multiline: bool = True) -> DataFrame | None:
    """All rows of an entity's drops (of ``dates`` only, if given) as text with ``load_date``; None if nothing has landed."""
    root = path.rstrip("/")
    files = list_files(spark, root)
    if dates is not None:
        files = files.where(F.col(LOAD_DATE).isin(list(dates)))
    folders = sorted(r[0] for r in files.select(_folder("path")).distinct().collect())
    found = layouts(spark, folders) if folders else []
    return read_layouts(spark, found, root, multiline) if found else None


def types_by_date(df: DataFrame, found: Sequence[Layout]) -> DataFrame:
    """(load_date, column_name, in_header, present_rows, inferred_type) for every date and column.

    One grouped aggregate over the text; a type is the narrowest that all
    present cells of the date fit, NULL if there are none.
    """
    names = [c for c in df.columns if c != LOAD_DATE]
    cells = [f"CASE WHEN {q(c)} IS NOT NULL AND {q(c)} <> '' THEN {cell_class(q(c))} END AS `c{i}`" for i, c in enumerate(names)]
    aggs = [e for i in range(len(names)) for e in (F.count(f"c{i}").alias(f"n{i}"), F.bit_and(f"c{i}").alias(f"m{i}"))]
    one = df.selectExpr(LOAD_DATE, *cells).groupBy(LOAD_DATE).agg(*aggs)
    arms = " ".join(f"WHEN m & {1 << b} <> 0 THEN '{t}'" for b, t in enumerate(CANDIDATES))
    rows = ", ".join(f"struct('{c}' AS column_name, `n{i}` AS present_rows, `m{i}` AS m)".replace("\\", "\\\\") for i, c in enumerate(names))
    typed = one.selectExpr(LOAD_DATE, f"inline(array({rows}))").selectExpr(
        LOAD_DATE, "column_name", "present_rows", f"CASE WHEN present_rows > 0 THEN CASE {arms} ELSE 'string' END END AS inferred_type")
    # one row per date and column of its headers: bounded by the dates landed
    spark = df.sparkSession
    held = spark.createDataFrame(sorted({(d, c) for x in found for d in x.dates for c in x.columns}), f"{LOAD_DATE} string, column_name string")
    return typed.join(held.withColumn("in_header", F.lit(True)), [LOAD_DATE, "column_name"], "left").select(
        LOAD_DATE, "column_name", F.coalesce("in_header", F.lit(False)).alias("in_header"), "present_rows", "inferred_type")


def drift(types: DataFrame) -> DataFrame:
    """(load_date, column_name, change, old_type, new_type): what changed against the date before.

    ``added`` and ``removed`` go by the headers, ``retyped`` by the last known
    type of the column (a date whose cells are all empty says nothing).
    """
    before = Window.partitionBy("column_name").orderBy(LOAD_DATE)
    known = before.rowsBetween(Window.unboundedPreceding, -1)
    seen = types.select("*", F.lag("in_header").over(before).alias("was"), F.last("inferred_type", ignorenulls=True).over(known).alias("old_type"))
    change = (F.when(F.col("in_header") & ~F.col("was"), "added").when(~F.col("in_header") & F.col("was"), "removed")
              .when(F.col("in_header") & (F.col("inferred_type") != F.col("old_type")), "retyped"))
    return seen.select(LOAD_DATE, "column_name", change.alias("change"), "old_type", F.col("inferred_type").alias("new_type")).where("change IS NOT NULL")


# -- ledger -------------------------------------------------------------------

_EVENTS = "path string, load_date string, length long, modified timestamp, event string, seq long"


def ledger_events(spark: SparkSession, ledger: str) -> DataFrame:
    """Every event of a ledger: files ``added``, ``changed`` and ``deleted``, run by run (``seq``)."""
    try:
        return spark.read.schema(_EVENTS).parquet(ledger)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _EVENTS)


def pending(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The events that bring the ledger up to what lies below ``path``; ``record`` them once they are dealt with.

    A deleted file is an event like the others: it is logged, what was built
    from it stays until its date is rebuilt.
    """
    events = ledger_events(spark, ledger)
    last = (events.groupBy("path").agg(F.max_by(F.struct(LOAD_DATE, "length", "modified", "event"), "seq").alias("s"))
            .select(F.col("path").alias("old_path"), F.col("s.load_date").alias("old_date"), F.col("s.length").alias("old_length"),
                    F.col("s.modified").alias("old_modified"), F.col("s.event").alias("old_event")).where("old_event <> 'deleted'"))
    seq = (events.agg(F.max("seq")).first()[0] or 0) + 1
    both = list_files(spark, path).join(last, F.col("path") == F.col("old_path"), "full")
    event = (F.when(F.col("old_path").isNull(), "added").when(F.col("path").isNull(), "deleted")
             .when((F.col("length") != F.col("old_length")) | (F.col("modified") != F.col("old_modified")), "changed"))
    return both.withColumn("event", event).where("event IS NOT NULL").select(
        F.coalesce("path", "old_path").alias("path"), F.coalesce(LOAD_DATE, "old_date").alias(LOAD_DATE),
        F.coalesce("length", "old_length").alias("length"), F.coalesce("modified", "old_modified").alias("modified"),
        "event", F.lit(seq).cast("long").alias("seq"))


def record(events: DataFrame, ledger: str) -> None:
    """Append events to a ledger."""
    events.coalesce(1).write.mode("append").parquet(ledger)


# -- registration ---------------------------------------------------------------

class MixedDrop(ValueError):
    """Files of one folder have different headers, which a table's partitions cannot tell apart."""


def register_layouts(spark: SparkSession, database: str, name: str, path: str) -> DataFrame:
    """Register an entity's drops as the view ``database.name``: every column by its name, whatever the files' order.

    Each layout is a partitioned CSV table of its own (``name__1``, ...) that
    checks the headers; the view unites them.  A later call takes new dates and
    layouts in and replaces the view.
    """
    root = path.rstrip("/")
    files = list_files(spark, root)
    folders = sorted(r[0] for r in files.select(_folder("path")).distinct().collect())
    found = layouts(spark, folders) if folders else []
    if not found:
        raise FileNotFoundError(f"no landing files at {root}")
    if mixed := [f for layout in found for f in layout.files]:
        raise MixedDrop(f"files of one folder have different headers: {mixed[:5]}")
    names = list(dict.fromkeys(c for layout in found for c in layout.columns))
    options = ", ".join(f"'{k}' '{v}'" for k, v in (CSV_OPTIONS | {"enforceSchema": "false"}).items())
    parts = []
    for i, layout in enumerate(found, 1):
        full = f"{q(database)}.{q(f'{name}__{i}')}"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        columns = ", ".join(f"{q(c)} STRING" for c in layout.columns)
        dated = all(layout.dates)
        spark.sql(f"CREATE TABLE {full} ({columns}{f', {LOAD_DATE} STRING' if dated else ''}) USING csv OPTIONS ({options}) "
                  + (f"PARTITIONED BY ({LOAD_DATE}) LOCATION '{root}'" if dated else f"LOCATION '{layout.folders[0]}'"))
        if dated:
            spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS " + " ".join(
                f"PARTITION ({LOAD_DATE}='{folder.rsplit('=', 1)[1]}') LOCATION '{folder}'" for folder in layout.folders))
        parts.append("SELECT " + ", ".join([q(c) if c in layout.columns else f"CAST(NULL AS STRING) AS {q(c)}" for c in names]
                                           + [LOAD_DATE if dated else f"CAST(NULL AS STRING) AS {LOAD_DATE}"]) + f" FROM {full}")
    full = f"{q(database)}.{q(name)}"
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS " + " UNION ALL ".join(parts))
    return spark.table(full)

"""Bronze layer: CSV landing files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.numeric import q
from fundlake.schemas import BRONZE_ENTITIES, text_schema

# CSV dialect of the landing files.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"',
               "multiLine": "true"}
LOAD_DATE = "load_date"


def entity_path(root: str, entity: str) -> str:
    if entity not in BRONZE_ENTITIES:
        raise KeyError(f"unknown Bronze entity {entity!r}")
    return f"{root.rstrip('/')}/{entity}"


class MissingDrop(FileNotFoundError):
    """An entity has no landing files for the load date that was asked for."""


def read_bronze(spark: SparkSession, root: str, entity: str,
                load_date: str | None = None, multiline: bool = True,
                allow_empty: bool = False) -> DataFrame:
    """All-text DataFrame of one Bronze entity (S1), one load date.

    One load date is read from its own folder by its own header, whatever
    other dates' files look like.  With no ``load_date`` every date is read;
    files whose header differs then fail the read instead of being taken by
    position.  Columns are strings (no inference); quoted fields may hold
    commas, doubled quotes and newlines.  Multi-line parsing reads each file
    in one task (files are the unit of parallelism, as the landing writer
    produces one per task); ``multiline=False`` splits large files when the
    producer guarantees no newline inside a value.

    A drop that does not exist raises :class:`MissingDrop`;
    ``allow_empty=True`` reads it as an empty text table.
    """
    path = entity_path(root, entity)
    leaf = path if load_date is None else f"{path}/{LOAD_DATE}={load_date}"
    try:
        df = (spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
              .option("inferSchema", "false").option("enforceSchema", "false")
              .option("basePath", path).csv(leaf))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        if not allow_empty:
            raise MissingDrop(f"no landing files for {entity} at {leaf}") from e
        return spark.createDataFrame([], text_schema(BRONZE_ENTITIES[entity][0]))
    return df.drop(LOAD_DATE)


def read_bronze_all(spark: SparkSession, root: str, load_date: str | None = None,
                    entities=None, multiline: bool = True,
                    allow_empty: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Every entity; those in ``allow_empty`` may be absent."""
    return {e: read_bronze(spark, root, e, load_date, multiline, e in allow_empty)
            for e in (entities or BRONZE_ENTITIES)}


def write_bronze(df: DataFrame, root: str, entity: str, load_date: str,
                 mode: str = "overwrite") -> str:
    """Land ``df`` as CSV under ``<root>/<entity>/load_date=<d>/``.

    Values with separators, quotes or newlines are quoted and their quotes
    doubled; NULL is written as an empty field.  Overwrite is dynamic per
    partition, so other load dates stay.  Returns the entity path.
    """
    return write_drops(df.withColumn(LOAD_DATE, F.lit(load_date)), root, entity, mode)


def write_drops(df: DataFrame, root: str, entity: str, mode: str = "overwrite") -> str:
    """Land the rows of many load dates, named by ``df``'s column ``load_date``, as :func:`write_bronze` does."""
    path = entity_path(root, entity)
    text = df.selectExpr(*[f"CAST({q(c)} AS STRING) AS {q(c)}" for c in df.columns])
    (text.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"})
         .option("emptyValue", "").option("nullValue", "")
         .partitionBy(LOAD_DATE).csv(path))
    return path


def write_bronze_all(frames: Mapping[str, DataFrame], root: str, load_date: str) -> list[str]:
    return [write_bronze(df, root, e, load_date) for e, df in frames.items()]

"""Incremental Bronze -> Silver ingest with Structured Streaming.

The batch job re-reads one whole ``load_date`` per run.  Here each Bronze
entity directory is a streaming file source; a run with
``trigger(availableNow=True)`` picks up only the landing files not seen
before (tracked in the checkpoint), and ``foreachBatch`` rebuilds the Silver
partitions of the load dates that arrived.  Rebuilding whole dates with a
dynamic partition overwrite makes a replayed micro-batch idempotent, and the
entities whose Silver table needs a join or a window (financials, cash
flows) are rebuilt from the complete Bronze text of those dates.  A table is
rebuilt whenever any of its entities lands something, so a feed that arrives
late is joined in; until then it counts as empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fundlake.plans import silver
from fundlake.plans.backfill import SILVER_SOURCES, dated_table, write_dates
from fundlake.schemas import BRONZE_ENTITIES
from fundlake.sources.bronze import LOAD_DATE, entity_path

def bronze_stream(spark: SparkSession, bronze_root: str, entity: str) -> DataFrame:
    """Change feed of one Bronze entity: the lines of landing files not seen
    before, with their ``load_date``.  Only the dates are used; the rebuild
    reads whole dates with the header-aware batch reader, so column order in
    the files does not matter here."""
    if entity not in BRONZE_ENTITIES:
        raise KeyError(entity)
    path = entity_path(bronze_root, entity)
    return (spark.readStream.format("text").schema(f"value string, {LOAD_DATE} string")
            .option("basePath", path).load(path))


def _landed(spark: SparkSession, bronze_root: str, entity: str) -> bool:
    """Whether the entity has a folder yet (a stream cannot start without one)."""
    try:
        spark.read.format("text").load(entity_path(bronze_root, entity))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise
    return True


def rebuild_dates(spark: SparkSession, bronze_root: str, silver_root: str, table: str,
                  dates: Sequence[str], as_of_year: int = silver.DEFAULT_AS_OF_YEAR) -> None:
    """Rebuild the Silver partitions of ``dates`` for one table (whole dates, one plan for all of them)."""
    write_dates(dated_table(spark, bronze_root, table, dates, as_of_year), silver_root, table)


def ingest(spark: SparkSession, bronze_root: str, silver_root: str, checkpoint_root: str,
           tables: Sequence[str] | None = None,
           as_of_year: int = silver.DEFAULT_AS_OF_YEAR) -> dict[str, int]:
    """Process every Bronze landing file not yet ingested; returns, per Silver
    table, how many load dates were rebuilt in this run."""
    rebuilt: dict[str, set[str]] = {}
    for table in tables or SILVER_SOURCES:
        rebuilt[table] = set()
        for entity in SILVER_SOURCES[table][0]:

            def on_batch(batch: DataFrame, epoch_id: int, table=table) -> None:
                # one small row per new load date (bounded by the dates landed)
                dates = sorted(r[0] for r in batch.select(LOAD_DATE).distinct().collect())
                if dates:
                    rebuild_dates(spark, bronze_root, silver_root, table, dates, as_of_year)
                    rebuilt[table].update(dates)

            if not _landed(spark, bronze_root, entity):
                continue
            q = (bronze_stream(spark, bronze_root, entity).writeStream
                 .foreachBatch(on_batch)
                 .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{table}/{entity}")
                 .trigger(availableNow=True).start())
            q.awaitTermination()
    return {table: len(dates) for table, dates in rebuilt.items()}

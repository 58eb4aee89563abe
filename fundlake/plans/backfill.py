"""Incremental Silver over many load dates: a ledger of landed files, one plan per table.

A run compares what has landed with the ledger (``sources.discover``), rebuilds
the load dates that have new, changed or deleted files, all of them in one plan
per table, and then records the files.  Silver tables are partitioned by
``load_date`` and only the rebuilt dates are overwritten.  The ledger is written
last: a run that fails is repeated with the same dates, and rebuilding whole
dates gives the same partitions again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.plans import silver
from fundlake.schemas import BRONZE_ENTITIES, text_schema
from fundlake.sources.bronze import LOAD_DATE, entity_path
from fundlake.sources.discover import pending, read_dates, record

# Silver table -> Bronze entities it is built from, and its builder.
SILVER_SOURCES = {
    "portfolio_companies": (("portfolio-companies",), silver.portfolio_companies),
    "company_financials": (("company-revenue", "company-ebitda"), silver.company_financials),
    "quarterly_cashflows": (("cashflows",), silver.quarterly_cashflows),
    "fund_history": (("fund-history",), silver.fund_history),
    "fund_metrics": (("fund-metrics",), silver.fund_metrics),
    "deal_pipeline": (("deal-pipeline",), silver.deal_pipeline),
    "sector_breakdown": (("sector-breakdown",), silver.sector_breakdown),
    "geo_breakdown": (("geo-breakdown",), silver.geo_breakdown),
}


def dated_text(spark: SparkSession, bronze_root: str, entity: str, dates: Sequence[str] | None = None) -> DataFrame:
    """The entity's text of ``dates`` (all, if not given) with ``load_date``; an empty table if none has landed.

    Columns that no drop holds are there as NULL, so a table can be built from
    drops that lack some.
    """
    df = read_dates(spark, entity_path(bronze_root, entity), dates)
    wanted = text_schema(BRONZE_ENTITIES[entity][0])
    if df is None:
        return spark.createDataFrame([], wanted).withColumn(LOAD_DATE, F.lit(None).cast("string"))
    return df.withColumns({f.name: F.lit(None).cast("string") for f in wanted if f.name not in df.columns})


def dated_table(spark: SparkSession, bronze_root: str, table: str, dates: Sequence[str] | None = None,
                as_of_year: int = silver.DEFAULT_AS_OF_YEAR) -> DataFrame:
    """One Silver table over many load dates, each by itself; the plan does not grow with their number."""
    entities, build = SILVER_SOURCES[table]
    frames = [dated_text(spark, bronze_root, e, dates) for e in entities]
    more = {"as_of_year": as_of_year} if table == "portfolio_companies" else {}
    return build(*frames, keep=(LOAD_DATE,), **more)


def write_dates(df: DataFrame, silver_root: str, table: str) -> None:
    """Overwrite the partitions of the load dates that ``df`` holds; others stay."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(LOAD_DATE).parquet(f"{silver_root.rstrip('/')}/{table}"))


def _drop_dates(spark: SparkSession, silver_root: str, table: str, dates: Sequence[str]) -> None:
    """Empty the partitions of ``dates``: nothing landed for them is left."""
    path = f"{silver_root.rstrip('/')}/{table}"
    try:
        there = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if LOAD_DATE in there.columns:
        for d in dates:
            fs.delete(jvm.org.apache.hadoop.fs.Path(folder, f"{LOAD_DATE}={d}"), True)


def backfill(spark: SparkSession, bronze_root: str, silver_root: str, tables: Sequence[str] | None = None,
             as_of_year: int = silver.DEFAULT_AS_OF_YEAR, ledger: str | None = None) -> dict[str, list[str]]:
    """Bring Silver up to what has landed; per table the load dates that were rebuilt.

    A table is rebuilt for a date when any of its entities has an event for it.
    A date whose drop was deleted loses its partition.
    """
    ledger = ledger or f"{silver_root.rstrip('/')}/_ledger"
    rebuilt: dict[str, list[str]] = {}
    for table in tables or SILVER_SOURCES:
        entities = SILVER_SOURCES[table][0]
        # a table's own ledger: an entity may feed tables that are built at other times
        logs = {e: f"{ledger}/{table}/{e}" for e in entities}
        events = {e: pending(spark, entity_path(bronze_root, e), log).persist() for e, log in logs.items()}
        dates = sorted({r[0] for found in events.values() for r in found.select(LOAD_DATE).distinct().collect()})
        if dates:
            df = dated_table(spark, bronze_root, table, dates, as_of_year)
            write_dates(df, silver_root, table)
            left = {r[0] for e in entities[:1] for r in dated_text(spark, bronze_root, e, dates).select(LOAD_DATE).distinct().collect()}
            _drop_dates(spark, silver_root, table, [d for d in dates if d not in left])
            for e, found in events.items():
                record(found, logs[e])
        for found in events.values():
            found.unpersist()
        rebuilt[table] = dates
    return rebuilt

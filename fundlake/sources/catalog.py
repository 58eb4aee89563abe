"""Layer namespaces and table registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundlake.schemas import LAYERS
from fundlake.sources.discover import register_layouts


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_layers(spark: SparkSession, root: str, layers=LAYERS) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` per layer, located under ``root``."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(layer)} "
                  f"LOCATION '{root.rstrip('/')}/{layer}.db'")
    return list(layers)


def register_table(spark: SparkSession, database: str, name: str, path: str,
                   fmt: str = "parquet") -> DataFrame:
    """Register files at ``path`` as ``database.name`` (schema from the files).

    Parquet takes its schema from the footers; CSV (Bronze) becomes a view that
    reads every drop by its own header (``discover.register_layouts``).
    Re-registering replaces the table definition (the files stay).
    """
    if fmt == "csv":
        return register_layouts(spark, database, name, path)
    full = f"{_q(database)}.{_q(name)}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    # files written by later runs may add columns: merge footers' schemas
    opts = " OPTIONS ('mergeSchema' 'true')" if fmt == "parquet" else ""
    spark.sql(f"CREATE TABLE {full} USING {fmt}{opts} LOCATION '{path}'")
    if spark.table(full).columns and "load_date" in spark.table(full).columns:
        spark.catalog.recoverPartitions(f"{database}.{name}")
    return spark.table(full)


def list_layer(spark: SparkSession, database: str) -> DataFrame:
    """Tables registered in one layer (catalog listing)."""
    return spark.sql(f"SHOW TABLES IN {_q(database)}")

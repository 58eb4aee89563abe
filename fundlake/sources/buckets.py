"""Co-partitioned tables: Parquet in hash buckets of a key.

Tables with the same number of buckets over keys of one type join, aggregate and
window on the key without an exchange, each read from where the last job left it.
The bucketing is part of a table's definition, so a folder is read through a
table of ``DATABASE`` (definitions only; the files stay where the run put them).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.numeric import q

DATABASE = "fundlake_buckets"


@dataclass(frozen=True)
class Buckets:
    """How a table is laid out: bucket columns and number, sort order, columns as DDL text."""

    columns: tuple[str, ...]
    count: int
    sort: tuple[str, ...]
    ddl: str

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str | None) -> Buckets | None:
        if not text:
            return None
        d = json.loads(text)
        return cls(tuple(d["columns"]), d["count"], tuple(d["sort"]), d["ddl"])

    def create(self, spark: SparkSession, full: str, path: str) -> DataFrame:
        """Define ``full`` (quoted) over the files at ``path``, if it is not defined."""
        cols, sort = (", ".join(q(c) for c in names) for names in (self.columns, self.sort))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({self.ddl}) USING parquet CLUSTERED BY ({cols}) "
                  f"SORTED BY ({sort}) INTO {self.count} BUCKETS LOCATION '{path}'")
        return spark.table(full)


def _full(name: str) -> str:
    return f"{q(DATABASE)}.{q(name)}"


def write_buckets(df: DataFrame, path: str, columns: Sequence[str], sort: Sequence[str] = (),
                  count: int | None = None) -> tuple[int, Buckets]:
    """Write ``df`` to ``path`` in ``count`` buckets (default: the shuffle partitions); rows written and layout.

    The rows are dealt by the hash that the buckets use, so there is one file a
    bucket (a plan that ends in that partitioning is not shuffled again).  NULL
    keys are one bucket.  A key's rows stay together: use it where a key's rows are
    bounded (one company's years), not for raw rows with hot keys.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(DATABASE)}")
    n = count or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = tuple(sort) or tuple(columns)
    ddl = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
    obs, full = Observation(f"rows_{uuid.uuid4().hex}"), _full(f"write_{uuid.uuid4().hex}")
    try:
        (df.repartition(n, *columns).observe(obs, F.count(F.lit(1)).alias("rows"))
           .write.format("parquet").mode("errorifexists").bucketBy(n, *columns).sortBy(*sort)
           .option("path", path).saveAsTable(full))
    finally:  # the definition goes, the files stay
        spark.sql(f"DROP TABLE IF EXISTS {full}")
    return int(obs.get["rows"]), Buckets(tuple(columns), n, sort, ddl)


def read_buckets(spark: SparkSession, path: str, layout: Buckets, name: str) -> DataFrame:
    """The table at ``path`` with its bucketing; ``name`` must be unique to the path."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(DATABASE)}")
    return layout.create(spark, _full(name), path)


def forget(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop the definitions of folders that are gone."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_full(name)}")

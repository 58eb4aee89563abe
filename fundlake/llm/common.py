"""Helpers shared by the training-data operators: tables, staged results, Arrow text columns.

Staged results are Parquet folders under the shared folder that the cluster
names in ``spark.checkpoint.dir`` (read through ``fundlake.session``), so a
lost executor never takes them along.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import checkpoint_dir

#: Bytes of text that one vectorised step takes at once (longer texts go alone).
BLOCK_BYTES = 2 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    That is enough where all machines see the driver's files; elsewhere the
    package goes along with the job (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    importable(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names not used by ``df`` (names compare without case)."""
    taken, names = {c.lower() for c in df.columns}, []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def as_column(name: str):
    """The column of exactly this name, dots and backticks in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str = "text"):
    return F.coalesce(as_column(name).cast("string"), F.lit(""))


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        width = np.dtype(np.int32)
    else:
        width = np.dtype(np.int64)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width, len(column) + 1, column.offset * width.itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes each; a longer row makes a block of its own."""
    rows, a = len(offsets) - 1, 0
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), rows)
        yield a, b
        a = b

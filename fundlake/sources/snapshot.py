"""Layer snapshots: the tables of one run become visible together.

A run writes every table to a folder of its own.  When all are written, each
row count is checked against what is read back, and one row appended to the
layer's manifest makes them the current version.  A run that fails before
that leaves readers, and the catalog, with the version they had; its folder
is removed by ``vacuum``.  Earlier versions stay readable until then.

The manifest is a folder of one-row JSON files, so appending is one file that
appears whole or not at all on any file system Spark writes to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fundlake.sources.buckets import Buckets, forget, read_buckets, write_buckets
from fundlake.sources.catalog import register_table
from fundlake.sources.tables import write_table

MANIFEST, RUNS = "_manifest", "_runs"
_SCHEMA = "version long, run_id string, tables array<struct<name:string,path:string,rows:long,layout:string>>"


class CountMismatch(RuntimeError):
    """A table does not read back as many rows as its write job reported."""


class ConcurrentRun(RuntimeError):
    """Another run published the same version first."""


@dataclass(frozen=True)
class Snapshot:
    """One published version of a layer: where each table lies and how many rows it has."""

    root: str
    version: int
    run_id: str
    paths: dict[str, str]
    rows: dict[str, int]
    layouts: dict[str, Buckets] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{self.paths[name]}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The table as it was written; one in buckets keeps its partitioning."""
        if name in self.layouts:
            return read_buckets(spark, self.path(name), self.layouts[name], _definition(self.paths[name]))
        return spark.read.parquet(self.path(name))


def _definition(path: str) -> str:
    """Name of a bucketed folder's definition: that of the table and its run."""
    _, run_id, name = path.split("/", 2)
    return f"{name}_{run_id}"


def _missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def versions(spark: SparkSession, root: str) -> list[Snapshot]:
    """All published versions, oldest first (one small row each).

    Of two runs that published the same version, the one with the smaller id counts.
    """
    root = root.rstrip("/")
    try:
        rows = spark.read.schema(_SCHEMA).json(f"{root}/{MANIFEST}").orderBy("version", "run_id").collect()
    except AnalysisException as e:
        if not _missing(e):
            raise
        return []
    out: dict[int, Snapshot] = {}
    for r in rows:
        out.setdefault(r["version"], Snapshot(root, r["version"], r["run_id"], {t["name"]: t["path"] for t in r["tables"]},
                                              {t["name"]: t["rows"] for t in r["tables"]},
                                              {t["name"]: Buckets.from_json(t["layout"]) for t in r["tables"] if t["layout"]}))
    return list(out.values())


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The last published version; None if the layer has none."""
    every = versions(spark, root)
    return every[-1] if every else None


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a layer (S3): that of the current version, or the plain folder
    ``<root>/<name>`` where none is published; filters and projections push down."""
    return read_layer(spark, root, [name])[name]


def read_layer(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Several tables of a layer, all of one version."""
    now = current(spark, root)
    return {name: now.read(spark, name) if now and name in now.paths else spark.read.parquet(f"{root.rstrip('/')}/{name}")
            for name in names}


class LayerRun:
    """The tables of one run, published by ``commit`` or not at all.

    ``keep`` carries tables of the version before into this one unchanged.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.before = current(spark, root)
        self.run_id = uuid.uuid4().hex
        self._paths: dict[str, str] = {}
        self._rows: dict[str, int] = {}
        self._layouts: dict[str, Buckets] = {}

    def write(self, df: DataFrame, name: str, sort_within: Sequence[str] = (), cluster_by: Sequence[str] = (),
              partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int | None = None,
              bloom_by: Sequence[str] = ()) -> int:
        """Write one table into the run's folder; the number of rows written.

        ``bucket_by`` lays it out in hash buckets (``sources.buckets``), sorted by ``sort_within``.
        """
        base = f"{RUNS}/{self.run_id}"
        if bucket_by:
            self._rows[name], self._layouts[name] = write_buckets(df, f"{self.root}/{base}/{name}", bucket_by, sort_within, buckets)
            self._paths[name] = f"{base}/{name}"
            return self._rows[name]
        self._rows[name] = write_table(df, f"{self.root}/{base}", name, mode="errorifexists", partition_by=partition_by,
                                       sort_within=sort_within, cluster_by=cluster_by, bloom_by=bloom_by)
        self._paths[name] = f"{base}/{name}"
        return self._rows[name]

    def keep(self, *names: str) -> None:
        for name in names:
            self._paths[name], self._rows[name] = self.before.paths[name], self.before.rows[name]
            if name in self.before.layouts:
                self._layouts[name] = self.before.layouts[name]

    def read(self, name: str) -> DataFrame:
        """A table of this run, before it is published."""
        return Snapshot(self.root, 0, self.run_id, self._paths, self._rows, self._layouts).read(self.spark, name)

    def check(self) -> None:
        """Compare each count with the rows that are there (from the files' footers)."""
        for name, n in self._rows.items():
            there = self.read(name).count()
            if there != n:
                raise CountMismatch(f"{name}: {n} rows written, {there} rows read back")

    def commit(self) -> Snapshot:
        self.check()
        version = self.before.version + 1 if self.before else 1
        tables = [(name, path, self._rows[name], self._layouts[name].to_json() if name in self._layouts else None)
                  for name, path in self._paths.items()]
        row = self.spark.createDataFrame([(version, self.run_id, tables)], _SCHEMA).coalesce(1)
        row.write.mode("append").json(f"{self.root}/{MANIFEST}")
        now = next(s for s in versions(self.spark, self.root) if s.version == version)
        if now.run_id != self.run_id:
            raise ConcurrentRun(f"version {version} of {self.root} was published by run {now.run_id}")
        return now


def _location(spark: SparkSession, full: str) -> str | None:
    if not spark.catalog.tableExists(full):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def publish(spark: SparkSession, database: str, snapshot: Snapshot, names: Sequence[str] | None = None) -> list[str]:
    """Point the catalog's tables at a version, all of them or (if one fails) none."""
    switched: dict[str, str | None] = {}

    def register(name: str, location: str, layout: Buckets | None) -> None:
        if layout is None:
            register_table(spark, database, name, location)
        else:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
            layout.create(spark, f"`{database}`.`{name}`", location)

    def layout_at(location: str) -> Buckets | None:
        return next((layout for s in versions(spark, snapshot.root) for name, layout in s.layouts.items()
                     if location.endswith(s.paths[name])), None)

    try:
        for name in names or snapshot.paths:
            full = f"`{database}`.`{name}`"
            switched[name] = _location(spark, full)
            register(name, snapshot.path(name), snapshot.layouts.get(name))
    except Exception:
        for name, before in switched.items():
            if before is None:
                spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
            else:
                register(name, before, layout_at(before))
        raise
    return list(switched)


def vacuum(spark: SparkSession, root: str, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
    """Delete run folders that the last ``keep`` versions do not use and nothing has written to for a while; their ids.

    The age protects runs that are not published yet.
    """
    root = root.rstrip("/")
    used = {p.split("/")[1] for s in versions(spark, root)[-max(keep, 1):] for p in s.paths.values()}
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{RUNS}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    limit = jvm.java.lang.System.currentTimeMillis() - older_than_hours * 3_600_000
    gone = []
    for status in fs.listStatus(folder):
        run_id = status.getPath().getName()
        last = max([status.getModificationTime(), *[s.getModificationTime() for s in fs.listStatus(status.getPath())]])
        tables = [t.getPath().getName() for t in fs.listStatus(status.getPath())]
        if run_id not in used and last <= limit and fs.delete(status.getPath(), True):
            forget(spark, [f"{t}_{run_id}" for t in tables])
            gone.append(run_id)
    return sorted(gone)

"""Session defaults and shared-folder resolution."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of the prefix sums are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

LAKE_ROOT_CONF = "fundlake.lake.root"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fundlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ANSI mode stays on: the operators use ``try_cast`` / ``try_divide`` so
    malformed text and zero divisors become NULL instead of failing.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # remote (Connect) sessions have no local context
        pass
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` / the context's
    checkpoint dir).  Only a local-mode session without one (tests) gets a
    fresh scratch folder; a cluster session without one is an error, never a
    machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Connect: the server's configured folder is used
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder "
                           "(e.g. on the cluster's distributed file system)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="fundlake-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def lake_root(spark: SparkSession) -> str:
    """Root folder for written layers (Bronze landing, Silver, Gold).

    ``fundlake.lake.root`` wins; otherwise a folder inside the shared
    checkpoint folder, so no machine-local path is used on a cluster.
    """
    root = spark.conf.get(LAKE_ROOT_CONF, None)
    if root:
        return root.rstrip("/")
    return checkpoint_dir(spark).rstrip("/") + "/fundlake-lake"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the lake root (one per run, never reused)."""
    return f"{lake_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return uri[len("file:"):] if uri.startswith("file:") else uri


__all__ = ["get_session", "checkpoint_dir", "lake_root", "fresh_dir", "local_path", "materialize",
           "DEFAULT_CONF", "LAKE_ROOT_CONF"]


def materialize(df):
    """Compute ``df`` once and cut its lineage (reliable checkpoint).

    For a relation that several branches of one plan consume (e.g. holdings
    feeding portfolio statistics and two two-pass HHIs): Spark recomputes a
    shared subplan per branch unless the exchanges happen to be identical.
    The checkpoint goes to the shared checkpoint folder, so a lost executor
    does not lose it.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

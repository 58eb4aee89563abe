"""Batch jobs: Bronze -> Silver -> Gold, written as Parquet and registered.

One action per output table (the write), with its row count observed in
the same job.  Nothing is collected to the driver but counts.  A layer's tables
are published together (``sources.snapshot``): a job that fails leaves every
table, and the catalog, as they were.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators import cast_rejects
from fundlake.operators.validation import Rule, validate
from fundlake.plans import gold, silver
from fundlake.plans.checks import silver_rules
from fundlake.schemas import BRONZE_ENTITIES
from fundlake.sources import LayerRun, create_layers, publish, read_bronze_all, read_layer
from fundlake.sources.bronze import LOAD_DATE

SILVER_TABLES = ("portfolio_companies", "company_financials", "quarterly_cashflows",
                 "fund_history", "fund_metrics", "deal_pipeline", "sector_breakdown",
                 "geo_breakdown")

# Write-time layout.  Tables served by key lookups are range-clustered on the
# key (files and row groups cover narrow key ranges); others are sorted per task.
# Silver tables that Gold joins, groups and windows by company lie in hash buckets of it
# (``sources.buckets``): no job after Silver shuffles by company.
BUCKET_KEYS = {"portfolio_companies": ("id",), "company_financials": ("company_id",)}
BUCKET_SORT = {"portfolio_companies": ("id",), "company_financials": ("company_id", "year", "is_estimate")}
CLUSTER_KEYS = {"company_financials": ("company_id", "year"), "portfolio_table": ("id",)}
# Names are looked up too: Bloom filters, since the tables are clustered by id.
BLOOM_KEYS = {"company_financials": ("company_name",), "portfolio_table": ("name",)}
SORT_KEYS = {"pipeline": ("stage",), "quarterly_cashflows": ("row_num",),
             "cashflow_jcurve": ("row_num",)}


def _write_all(run: LayerRun, frames, bucketed=(), buckets: int | None = None) -> dict[str, int]:
    return {name: run.write(df, name, sort_within=BUCKET_SORT[name], bucket_by=BUCKET_KEYS[name], buckets=buckets)
            if name in bucketed else
            run.write(df, name, sort_within=SORT_KEYS.get(name, ()), cluster_by=CLUSTER_KEYS.get(name, ()),
                      bloom_by=BLOOM_KEYS.get(name, ()))
            for name, df in frames.items()}


Rules = Callable[[Mapping[str, DataFrame], Mapping[str, int]], Mapping[str, Sequence[Rule]]]


class RejectedTable(RuntimeError):
    """A table breaks a rule that concerns it as a whole."""


def _validated(run: LayerRun, frames: dict[str, DataFrame], rules: Rules) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(tables with their good rows, quarantined rows by table)."""
    good, bad = dict(frames), {}
    for name, chosen in rules(frames, run.before.rows if run.before else {}).items():
        judged = validate(frames[name], chosen)
        whole = [r.name for r in chosen if r.kind == "rows"]
        # one row per rule
        for line in judged.report.where("NOT passed").collect():
            if line["rule"] in whole:
                raise RejectedTable(f"{name}: {line['checked_rows']} rows break {line['rule']}")
        good[name], bad[name] = judged.good, judged.quarantined
    return good, bad


def _publish(spark: SparkSession, run: LayerRun, layer: str, register: bool) -> None:
    snapshot = run.commit()
    if register:
        create_layers(spark, run.root.rsplit("/", 1)[0], [layer])
        publish(spark, layer, snapshot)


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, load_date: str,
               as_of_year: int = silver.DEFAULT_AS_OF_YEAR,
               register: bool = False, quarantine: bool = False, multiline: bool = True,
               allow_empty: Sequence[str] = (), buckets: int | None = None,
               rules: Rules | None = None) -> dict[str, int]:
    """Bronze CSV of one load date -> eight Silver Parquet tables; rows written.

    All drops are looked up before the first table is written: a missing one
    fails the run (unless ``allow_empty`` names its entity).  The tables are
    published together at the end, so any failure leaves Silver as it was.  ``multiline=False`` lets large files be split.
    Company tables lie in ``buckets`` hash buckets (default: the shuffle partitions).

    ``quarantine=True`` also writes, per Bronze entity, every cell whose text
    is present but does not cast to its Silver type (``_rejects/<entity>``,
    one row per cell with the row's first column as key) and reports the
    counts as ``rejects:<entity>``.

    ``rules`` (such as ``checks.silver_rules``) gives the rules of each table: rows that
    break one go whole to ``_quarantine/<table>``, counted as ``quarantined:<table>``,
    and a table that breaks a rule of its row count fails the run.
    """
    bronze = read_bronze_all(spark, bronze_root, load_date, multiline=multiline,
                             allow_empty=allow_empty)
    run = LayerRun(spark, silver_root)
    frames, bad = silver.build_silver(bronze, as_of_year), {}
    if rules:
        frames, bad = _validated(run, frames, rules)
    counts = _write_all(run, frames, BUCKET_KEYS, buckets)
    if bad:
        broken = LayerRun(spark, f"{silver_root.rstrip('/')}/_quarantine")
        counts |= {f"quarantined:{name}": broken.write(df, name) for name, df in bad.items()}
        broken.commit()
    if quarantine:
        quarantined = LayerRun(spark, f"{silver_root.rstrip('/')}/_rejects")
        for entity, raw in bronze.items():
            schema = BRONZE_ENTITIES[entity][0]
            rejects = cast_rejects(raw, schema, keys=[raw.columns[0]])
            counts[f"rejects:{entity}"] = quarantined.write(rejects, entity)
        quarantined.commit()
    _publish(spark, run, "silver", register)
    return counts


def _one_date(df: DataFrame, name: str, load_date: str | None) -> DataFrame:
    if LOAD_DATE not in df.columns:
        return df
    if load_date is None:
        raise ValueError(f"{name} is partitioned by {LOAD_DATE}: name the date to build Gold from")
    return df.where(F.col(LOAD_DATE).cast("string") == load_date).drop(LOAD_DATE)


def run_gold(spark: SparkSession, silver_root: str, gold_root: str,
             register: bool = False, load_date: str | None = None) -> dict[str, int]:
    """Silver Parquet -> eleven Gold Parquet tables; rows written.

    Silver that streaming ingest wrote holds all dates, partitioned by
    ``load_date``; ``load_date`` takes one of them (Silver of the batch job
    holds one date only and has no such column).
    """
    tables = read_layer(spark, silver_root, SILVER_TABLES)
    sv = {name: _one_date(df, name, load_date) for name, df in tables.items()}
    run = LayerRun(spark, gold_root)
    counts = _write_all(run, gold.build_gold(sv))
    _publish(spark, run, "gold", register)
    return counts


def main(argv=None) -> None:
    """Command line: ``python -m fundlake.plans.etl silver|gold|all ...``.

    Paths are folders on the cluster's shared file system; the session's
    own settings (``spark.checkpoint.dir`` etc.) come from spark-submit.
    """
    import argparse
    import json

    from fundlake.session import get_session

    ap = argparse.ArgumentParser(prog="fundlake-etl")
    ap.add_argument("step", choices=["silver", "gold", "all"])
    ap.add_argument("--bronze-root")
    ap.add_argument("--silver-root", required=True)
    ap.add_argument("--gold-root")
    ap.add_argument("--load-date")
    ap.add_argument("--as-of-year", type=int, default=silver.DEFAULT_AS_OF_YEAR)
    ap.add_argument("--register", action="store_true")
    ap.add_argument("--quarantine", action="store_true")
    ap.add_argument("--validate", action="store_true", help="quarantine rows that break the rules of Silver")
    ap.add_argument("--split-files", action="store_true",
                    help="no value holds a newline: split large CSV files")
    ap.add_argument("--allow-empty", nargs="*", default=(), metavar="ENTITY")
    a = ap.parse_args(argv)
    spark = get_session(app_name=f"fundlake-{a.step}")
    out = {}
    if a.step in ("silver", "all"):
        if not (a.bronze_root and a.load_date):
            ap.error("silver needs --bronze-root and --load-date")
        out["silver"] = run_silver(spark, a.bronze_root, a.silver_root, a.load_date,
                                   a.as_of_year, a.register, a.quarantine,
                                   not a.split_files, a.allow_empty, rules=silver_rules if a.validate else None)
    if a.step in ("gold", "all"):
        if not a.gold_root:
            ap.error("gold needs --gold-root")
        out["gold"] = run_gold(spark, a.silver_root, a.gold_root, a.register, a.load_date)
    print(json.dumps(out))


if __name__ == "__main__":
    main()

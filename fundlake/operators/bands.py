"""Banding (C2, C3), first-match flags (C1) and band summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import q, sql_avg, sql_round, sql_sum
from fundlake.functions.rules import bucketize_expr, first_match_expr

# Band edges and labels, as the dashboards show them.
LEVERAGE_EDGES = (3.0, 5.0, 7.0)
LEVERAGE_LABELS = ("≤3x Conservative", "3-5x Moderate", "5-7x Elevated", ">7x High")
MOIC_EDGES = (1.0, 1.5, 2.0, 3.0)
MOIC_LABELS = ("<1x Below cost", "1-1.5x Low", "1.5-2x Moderate", "2-3x Good", "≥3x Excellent")
# Risk flags and their thresholds.
RISK_WATCH, RISK_HIGH_LEVERAGE, RISK_BELOW_COST, RISK_OK = (
    "WATCH", "HIGH_LEVERAGE", "BELOW_COST", "OK")
HIGH_LEVERAGE_ABOVE = 6.0
BELOW_COST_UNDER = 1.0


def bucketize(df: DataFrame, col, edges: Sequence[float], labels: Sequence[str], out: str,
              closed: str = "right", null_label: str | None = None) -> DataFrame:
    """Add ``out`` = band label of ``col`` (see :func:`bucketize_expr`)."""
    return df.withColumn(out, bucketize_expr(col, edges, labels, closed, null_label))


def first_match(df: DataFrame, rules: Sequence[tuple[Column, str]], default: str,
                out: str) -> DataFrame:
    """Add ``out`` = label of the first rule whose condition is true."""
    return df.withColumn(out, first_match_expr(rules, default))


def risk_flag(df: DataFrame, status: str = "status", leverage: str = "net_leverage_x",
              moic: str = "moic", out: str = "risk_flag") -> DataFrame:
    """Ordered flag: Watch status, then leverage > 6, then moic < 1, else OK."""
    rules = [(f"{q(status)} = 'Watch'", RISK_WATCH),
             (f"{q(leverage)} > {HIGH_LEVERAGE_ABOVE!r}D", RISK_HIGH_LEVERAGE),
             (f"{q(moic)} < {BELOW_COST_UNDER!r}D", RISK_BELOW_COST)]
    return first_match(df, rules, RISK_OK, out)


def band_summary(df: DataFrame, band: str, sums: Mapping[str, str] | None = None,
                 avgs: Mapping[str, str] | None = None, count_as: str = "company_count",
                 scale: int = 2) -> DataFrame:
    """``groupBy(band)``: row count, rounded exact sums and means.

    ``sums`` / ``avgs`` map output name -> input column.  Map-side partial
    aggregation keeps a hot band from landing whole in one task.
    """
    aggs = [F.expr(f"count(1) AS {q(count_as)}")]
    aggs += [F.expr(f"{sql_round(sql_sum(q(c)), scale)} AS {q(o)}") for o, c in (sums or {}).items()]
    aggs += [F.expr(f"{sql_round(sql_avg(q(c)), scale)} AS {q(o)}") for o, c in (avgs or {}).items()]
    return df.groupBy(band).agg(*aggs)


def leverage_bands(portco: DataFrame, leverage: str = "net_leverage_x", fmv: str = "fmv",
                   null_label: str | None = None) -> DataFrame:
    """Companies and FMV by leverage band (NULL leverage -> top band by default)."""
    banded = bucketize(portco, leverage, LEVERAGE_EDGES, LEVERAGE_LABELS, "leverage_band",
                       closed="right", null_label=null_label)
    return band_summary(banded, "leverage_band", sums={"fmv_m": fmv})


def moic_bands(portco: DataFrame, moic: str = "moic", fmv: str = "fmv", irr: str = "irr",
               null_label: str | None = None) -> DataFrame:
    """Companies, FMV and mean IRR by MOIC band (NULL moic -> top band by default)."""
    banded = bucketize(portco, moic, MOIC_EDGES, MOIC_LABELS, "moic_band", closed="left",
                       null_label=null_label)
    return band_summary(banded, "moic_band", sums={"fmv_m": fmv}, avgs={"avg_irr": irr})

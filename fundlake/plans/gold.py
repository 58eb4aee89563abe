"""Gold tables G1-G11 composed from Silver tables.

No driver-side scalars: every portfolio-level number is a one-row global
aggregate attached by a broadcast cross join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import sql_avg, sql_round, sql_sum
from fundlake.operators import (attach_scalar, concentration, global_stats, group_enrich,
                                hhi, latest_per_key, leverage_bands, lookup, moic_bands,
                                risk_flag, weighted_mean, with_cagr)

# Status labels counted in the KPIs.
ACTIVE, WATCH = "Active", "Watch"


def fund_kpis(fm: DataFrame, portco: DataFrame) -> DataFrame:
    """G1: fund metrics + total FMV, total invested, Active and Watch counts."""
    stats = global_stats(portco, [
        F.expr(f"{sql_sum('fmv')} AS total_fmv_m"),
        F.expr(f"{sql_sum('invested_capital')} AS total_invested_m"),
        F.expr(f"count_if(status = '{ACTIVE}') AS active_companies"),
        F.expr(f"count_if(status = '{WATCH}') AS watch_companies")])
    return attach_scalar(fm, stats)


def nav_history(fh: DataFrame) -> DataFrame:
    """G2 (served ordered by quarter)."""
    return fh


def cashflow_jcurve(cf: DataFrame) -> DataFrame:
    """G3 (served ordered by row_num)."""
    return cf


def sector_allocation(sb: DataFrame, exact: bool = False) -> DataFrame:
    """Weight, HHI contribution, sector HHI on every row."""
    return concentration(sb, "fmv_m", "hhi_sector", exact=exact)


def geo_allocation(gb: DataFrame, exact: bool = False) -> DataFrame:
    """Weight, HHI contribution, geography HHI on every row."""
    return concentration(gb, "fmv_m", "hhi_geo", exact=exact)


LATEST_RENAME = {"year": "latest_fin_year", "revenue_m": "latest_revenue_m",
                 "ebitda_m": "latest_ebitda_m",
                 "ebitda_margin_pct": "latest_ebitda_margin_pct",
                 "revenue_yoy_pct": "latest_revenue_yoy_pct"}


def latest_financials(fin: DataFrame) -> DataFrame:
    """Latest actual year per company (W4 with F1); deterministic on ties."""
    return latest_per_key(fin, "company_id", "year", cols=list(LATEST_RENAME),
                          where="NOT is_estimate", rename=LATEST_RENAME)


def portfolio_table(portco: DataFrame, fin: DataFrame) -> DataFrame:
    """Company row + latest actual financials (left) + risk flag."""
    joined = lookup(portco, latest_financials(fin), {"id": "company_id"}, "left")
    return risk_flag(joined)


def company_financials(fin: DataFrame) -> DataFrame:
    """Full history + revenue CAGR over actual years.

    Window aggregates over ``company_id``: the YoY window has already
    partitioned the rows by company, so no second scan and no join.
    """
    return with_cagr(fin, "company_id", "year", "revenue_m", where="NOT is_estimate")


def stage_aggs() -> list:
    """A4: per-stage count, equity, weighted equity (2 dp), mean probability (1 dp)."""
    return [F.expr("count(1) AS stage_count"),
            F.expr(f"{sql_round(sql_sum('equity_m'), 2)} AS stage_equity_m"),
            F.expr(f"{sql_round(sql_sum('weighted_equity_m'), 2)} AS stage_weighted_m"),
            F.expr(f"{sql_round(sql_avg('probability'), 1)} AS stage_avg_prob")]


def pipeline(pl: DataFrame) -> DataFrame:
    """Every deal + its stage's count, equity, weighted equity, mean probability."""
    return group_enrich(pl, "stage", stage_aggs())


def risk_summary(portco: DataFrame, sb: DataFrame, gb: DataFrame,
                 null_weights: str = "keep") -> DataFrame:
    """One row of HHIs, leverage stats, FMV-weighted MOIC/IRR and counts."""
    stats = global_stats(portco, [
        F.expr(f"{sql_round(sql_avg('net_leverage_x'), 2)} AS avg_net_leverage_x"),
        F.expr(f"{sql_round('max(net_leverage_x)', 2)} AS max_net_leverage_x"),
        weighted_mean("moic", "fmv", null_weights).alias("weighted_avg_moic"),
        weighted_mean("irr", "fmv", null_weights).alias("weighted_avg_irr"),
        F.expr(f"count_if(status = '{ACTIVE}') AS active_count"),
        F.expr(f"count_if(status = '{WATCH}') AS watch_count")])
    one = attach_scalar(attach_scalar(hhi(sb, "fmv_m", "hhi_sector"),
                                      hhi(gb, "fmv_m", "hhi_geo")), stats)
    return one.select("hhi_sector", "hhi_geo", "avg_net_leverage_x", "max_net_leverage_x",
                      "weighted_avg_moic", "weighted_avg_irr", "active_count", "watch_count")


def risk_leverage_bands(portco: DataFrame) -> DataFrame:
    """G10."""
    return leverage_bands(portco)


def risk_moic_bands(portco: DataFrame) -> DataFrame:
    """G11."""
    return moic_bands(portco)


def build_gold(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Silver table name -> DataFrame  ==>  the eleven Gold tables."""
    pc, fin = silver["portfolio_companies"], silver["company_financials"]
    sb, gb = silver["sector_breakdown"], silver["geo_breakdown"]
    return {
        "fund_kpis": fund_kpis(silver["fund_metrics"], pc),
        "nav_history": nav_history(silver["fund_history"]),
        "cashflow_jcurve": cashflow_jcurve(silver["quarterly_cashflows"]),
        "sector_allocation": sector_allocation(sb),
        "geo_allocation": geo_allocation(gb),
        "portfolio_table": portfolio_table(pc, fin),
        "company_financials": company_financials(fin),
        "pipeline": pipeline(silver["deal_pipeline"]),
        "risk_summary": risk_summary(pc, sb, gb),
        "risk_leverage_bands": risk_leverage_bands(pc),
        "risk_moic_bands": risk_moic_bands(pc),
    }

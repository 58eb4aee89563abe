"""Silver tables T1-T8: typed projection + derived columns of Bronze input.

Each builder takes the Bronze DataFrame (text or already typed) and returns
a lazy DataFrame.  Columns named by ``keep`` (the load date, when the input holds
many) are carried along, and joins, growth and running totals stay within their
values.  ``build_silver`` maps Bronze entity names to all eight.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import schemas
from fundlake.operators import (difference, growth, product, ratio, running_total, total,
                                typed_select, years_held)

# Fixed value: the year "now" for holding periods.
DEFAULT_AS_OF_YEAR = 2026


def portfolio_companies(raw: DataFrame, as_of_year: int = DEFAULT_AS_OF_YEAR,
                        keep: Sequence[str] = ()) -> DataFrame:
    """P1 + D1-D5 (leverage only where current EBITDA > 0)."""
    df = typed_select(raw, schemas.PORTFOLIO_COMPANIES, keep=keep)
    df = years_held(df, "entry_year", as_of_year)
    df = difference(df, "current_multiple", "entry_multiple", "multiple_expansion")
    df = difference(df, "fmv", "invested_capital", "gross_value_creation_m")
    df = total(df, "fmv", "realized", "total_value_m")
    return ratio(df, "debt", "current_ebitda", "net_leverage_x", require_positive=True)


def _same(a: Column, b: Column, key: str, hashed: bool) -> Column:
    if hashed:
        return a == b
    if key == "is_estimate":  # an unreadable one (NULL) matches another unreadable one
        a, b = (F.coalesce(x.cast("int"), F.lit(2)) for x in (a, b))
    return a.between(b, b)


def company_financials(revenue_raw: DataFrame, ebitda_raw: DataFrame,
                       keys: Sequence[str] = ("company_id", "year", "is_estimate"),
                       keep: Sequence[str] = ()) -> DataFrame:
    """Revenue LEFT JOIN EBITDA, margin (D6), YoY growth.

    The join key includes ``is_estimate`` so an actual and an estimate of the
    same year stay two rows instead of fanning out 2x2; pass
    ``keys=("company_id", "year")`` for the year-only join.

    Only ``company_id`` (with ``keep``) is a hash key of the join: the other keys
    are ranges of one value, which the join tests within a company, so join and
    growth window share one partitioning by company.  A company has few years.
    """
    keys = [*keep, *keys]
    rev = typed_select(revenue_raw, schemas.COMPANY_REVENUE, keep=keep)
    eb = typed_select(ebitda_raw, schemas.COMPANY_EBITDA, keep=keep).select(*keys, "ebitda_m")
    eb = eb.select(*[eb[k].alias(f"_{k}") for k in keys], "ebitda_m")
    match = [_same(rev[k], eb[f"_{k}"], k, hashed=k == "company_id" or k in keep) for k in keys]
    fin = rev.join(eb, match, "left").select(
        "company_id", "year", "company_name", "is_estimate", "revenue_m", "ebitda_m", *[rev[c] for c in keep])
    fin = ratio(fin, "ebitda_m", "revenue_m", "ebitda_margin_pct", factor=100.0,
                require_positive=True)
    return growth(fin, [*keep, "company_id"], "year", ["revenue_m", "ebitda_m"],
                  tiebreak=["is_estimate"])


def quarterly_cashflows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P4 + cumulative contributions / distributions / net.

    Distributed prefix sum ordered by ``row_num`` (quarter label breaks ties).
    """
    cf = typed_select(raw, schemas.CASHFLOWS, keep=keep)
    return running_total(cf, "row_num", ["contributions_m", "distributions_m", "net_cashflow_m"],
                         tiebreak=["quarter"], group=keep)


def fund_history(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """T4: P5."""
    return typed_select(raw, schemas.FUND_HISTORY, keep=keep)


def fund_metrics(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """T5: P6 + deployed_pct (D7) and unrealised_pct (D8), NULL on a zero divisor."""
    fm = typed_select(raw, schemas.FUND_METRICS, keep=keep)
    fm = ratio(fm, "called_capital", "committed_capital", "deployed_pct", factor=100.0)
    return ratio(fm, "nav", "total_value", "unrealised_pct", factor=100.0)


def deal_pipeline(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P7 + probability-weighted equity."""
    pl = typed_select(raw, schemas.DEAL_PIPELINE, keep=keep)
    return product(pl, "equity_m", "probability", "weighted_equity_m", divisor=100.0)


def sector_breakdown(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P8."""
    return typed_select(raw, schemas.SECTOR_BREAKDOWN, keep=keep)


def geo_breakdown(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P9."""
    return typed_select(raw, schemas.GEO_BREAKDOWN, keep=keep)


def build_silver(bronze: Mapping[str, DataFrame],
                 as_of_year: int = DEFAULT_AS_OF_YEAR) -> dict[str, DataFrame]:
    """Bronze entity name -> DataFrame  ==>  Silver table name -> DataFrame."""
    return {
        "portfolio_companies": portfolio_companies(bronze["portfolio-companies"], as_of_year),
        "company_financials": company_financials(bronze["company-revenue"],
                                                 bronze["company-ebitda"]),
        "quarterly_cashflows": quarterly_cashflows(bronze["cashflows"]),
        "fund_history": fund_history(bronze["fund-history"]),
        "fund_metrics": fund_metrics(bronze["fund-metrics"]),
        "deal_pipeline": deal_pipeline(bronze["deal-pipeline"]),
        "sector_breakdown": sector_breakdown(bronze["sector-breakdown"]),
        "geo_breakdown": geo_breakdown(bronze["geo-breakdown"]),
    }


__all__ = ["portfolio_companies", "company_financials", "quarterly_cashflows", "fund_history",
           "fund_metrics", "deal_pipeline", "sector_breakdown", "geo_breakdown", "build_silver",
           "DEFAULT_AS_OF_YEAR"]

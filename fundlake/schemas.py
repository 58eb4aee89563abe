"""Table schemas for the three layers.

Bronze entities are text (header-defined CSV).  Silver schemas are the typed
projections P1-P9; columns not listed are dropped.  Identifiers are
``bigint`` (not ``int``) so that keys of a large lake never overflow.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, B, DT = (T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(),
                     T.BooleanType(), T.DateType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# P1 portfolio_companies
PORTFOLIO_COMPANIES = _schema(
    ("id", L), ("name", S), ("sector", S), ("subsector", S), ("geography", S),
    ("entry_year", I), ("entry_ev", D), ("entry_ebitda", D), ("entry_multiple", D),
    ("invested_capital", D), ("ownership_pct", D), ("current_ev", D), ("current_ebitda", D),
    ("current_multiple", D), ("fmv", D), ("moic", D), ("irr", D), ("status", S), ("debt", D),
    ("employees", I), ("description", S), ("realized", D))

# P2 revenue feed
COMPANY_REVENUE = _schema(("company_id", L), ("company_name", S), ("year", I),
                          ("is_estimate", B), ("revenue_m", D))

# P3 EBITDA feed (name dropped; is_estimate kept only as a join key)
COMPANY_EBITDA = _schema(("company_id", L), ("year", I), ("is_estimate", B), ("ebitda_m", D))

# P4 cashflows
CASHFLOWS = _schema(("row_num", L), ("quarter", S), ("contributions_m", D),
                    ("distributions_m", D), ("net_cashflow_m", D))

# P5 fund_history
FUND_HISTORY = _schema(("quarter", S), ("nav_m", D), ("net_irr", D), ("tvpi", D))

# P6 fund_metrics
FUND_METRICS = _schema(
    ("fund_name", S), ("short_name", S), ("vintage", I), ("strategy", S), ("geography", S),
    ("committed_capital", D), ("called_capital", D), ("uncalled_capital", D),
    ("distributions", D), ("nav", D), ("total_value", D), ("tvpi", D), ("dpi", D), ("rvpi", D),
    ("net_irr", D), ("gross_irr", D), ("moic", D), ("management_fee_pct", D), ("carry_pct", D),
    ("hurdle_rate_pct", D), ("num_portcos", I), ("as_of_date", DT))

# P7 deal_pipeline
DEAL_PIPELINE = _schema(
    ("id", L), ("name", S), ("sector", S), ("subsector", S), ("source", S), ("stage", S),
    ("target_ev_m", D), ("equity_m", D), ("ev_ebitda", D), ("probability", D), ("owner", S),
    ("description", S), ("notes", S))

# P8 sector_breakdown
SECTOR_BREAKDOWN = _schema(("sector", S), ("fmv_m", D), ("company_count", I),
                           ("portfolio_pct", D))

# P9 geo_breakdown
GEO_BREAKDOWN = _schema(("region", S), ("fmv_m", D), ("company_count", I))

# Bronze entity directory -> (Silver typed schema, Bronze file name).
# Landing directory names and file names of the Bronze layer.
BRONZE_ENTITIES = {
    "fund-metrics": (FUND_METRICS, "fund_metrics.csv"),
    "portfolio-companies": (PORTFOLIO_COMPANIES, "portfolio_companies.csv"),
    "company-revenue": (COMPANY_REVENUE, "company_revenue.csv"),
    "company-ebitda": (COMPANY_EBITDA, "company_ebitda.csv"),
    "cashflows": (CASHFLOWS, "quarterly_cashflows.csv"),
    "fund-history": (FUND_HISTORY, "fund_history.csv"),
    "deal-pipeline": (DEAL_PIPELINE, "deal_pipeline.csv"),
    "sector-breakdown": (SECTOR_BREAKDOWN, "sector_breakdown.csv"),
    "geo-breakdown": (GEO_BREAKDOWN, "geo_breakdown.csv"),
}

# Layer database names.
LAYERS = ("bronze", "silver", "gold")


def text_schema(schema: T.StructType) -> T.StructType:
    """All-string version of a typed schema (how Bronze text is read)."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])

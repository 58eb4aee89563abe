"""Nested fund records -> the nine Bronze entities.

Source records are JSON Lines, one file set per entity: one company, deal,
quarter, ... per line, so reading splits across tasks.  Company records
carry ``{year: value}`` maps for revenue and EBITDA, where a key ending in
``E`` marks an estimate.  Field names are camelCase; each entity maps them
to its Bronze columns with a fixed table.  With ``keep_extra`` the fields that no
table names become Bronze columns too (``sources.variants``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.operators import flatten, number_rows, unpivot_years
from fundlake.plans.views import QUARTER_KEY
from fundlake.sources import variants

S, D, L = T.StringType(), T.DoubleType(), T.LongType()
YEAR_MAP = T.MapType(T.StringType(), T.DoubleType())

# Source field -> Bronze column, per entity, in Bronze column order.
FUND_FIELDS = {
    "name": "fund_name", "shortName": "short_name", "vintage": "vintage",
    "strategy": "strategy", "geography": "geography", "committedCapital": "committed_capital",
    "calledCapital": "called_capital", "uncalledCapital": "uncalled_capital",
    "distributions": "distributions", "nav": "nav", "totalValue": "total_value", "tvpi": "tvpi",
    "dpi": "dpi", "rvpi": "rvpi", "irr": "net_irr", "grossIrr": "gross_irr", "moic": "moic",
    "managementFee": "management_fee_pct", "carry": "carry_pct", "hurdleRate": "hurdle_rate_pct",
    "numPortcos": "num_portcos", "asOf": "as_of_date"}
COMPANY_FIELDS = {
    "id": "id", "name": "name", "sector": "sector", "subsector": "subsector",
    "geography": "geography", "entryYear": "entry_year", "entryEV": "entry_ev",
    "entryEBITDA": "entry_ebitda", "entryMultiple": "entry_multiple",
    "invested": "invested_capital", "ownership": "ownership_pct", "currentEV": "current_ev",
    "currentEBITDA": "current_ebitda", "currentMultiple": "current_multiple", "fmv": "fmv",
    "moic": "moic", "irr": "irr", "status": "status", "debt": "debt", "employees": "employees",
    "description": "description", "realized": "realized"}
CASHFLOW_FIELDS = {"q": "quarter", "contributions": "contributions_m",
                   "distributions": "distributions_m"}
HISTORY_FIELDS = {"q": "quarter", "nav": "nav_m", "irr": "net_irr", "tvpi": "tvpi"}
DEAL_FIELDS = {
    "name": "name", "sector": "sector", "subsector": "subsector", "source": "source",
    "stage": "stage", "targetEV": "target_ev_m", "equity": "equity_m", "evEbitda": "ev_ebitda",
    "probability": "probability", "owner": "owner", "description": "description",
    "notes": "notes"}
SECTOR_FIELDS = {"sector": "sector", "fmv": "fmv_m", "count": "company_count",
                 "pct": "portfolio_pct"}
GEO_FIELDS = {"region": "region", "fmv": "fmv_m", "count": "company_count"}

_TEXT_FIELDS = {"name", "shortName", "strategy", "geography", "asOf", "sector", "subsector",
                "status", "description", "q", "source", "stage", "owner", "notes", "region"}
_LONG_FIELDS = {"id", "vintage", "numPortcos", "entryYear", "employees", "count"}


def _schema(fields, extra=()) -> T.StructType:
    out = T.StructType()
    for f in fields:
        out.add(f, S if f in _TEXT_FIELDS else L if f in _LONG_FIELDS else D)
    for name, dtype in extra:
        out.add(name, dtype)
    return out


def read_records(spark: SparkSession, path: str, fields, extra=()) -> DataFrame:
    """JSON Lines with an explicit schema (no inference pass over the data)."""
    return spark.read.schema(_schema(fields, extra)).json(path)


def read_with_extra(spark: SparkSession, path: str, fields: Mapping[str, str], extra=()) -> tuple[DataFrame, list[str]]:
    """:func:`read_records` and a column for every field outside the schema; the names of those columns."""
    return variants.read_records(spark, path, _schema(fields, extra), fields)


def companies_to_bronze(companies: DataFrame, keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Company records -> portfolio-companies, company-revenue, company-ebitda.

    ``realized`` missing -> 0 (D13); the year maps are unpivoted with the
    estimate suffix stripped and flagged (D17).  ``keep`` names further columns of
    the portfolio companies.
    """
    pc = flatten(companies, {**COMPANY_FIELDS, **{c: c for c in keep}}, defaults={"realized": 0.0})
    ids = [F.col("id").alias("company_id"), F.col("name").alias("company_name")]
    out = {"portfolio-companies": pc}
    for entity, col, value in (("company-revenue", "revenue", "revenue_m"),
                               ("company-ebitda", "ebitda", "ebitda_m")):
        feed = unpivot_years(companies.select(*ids, col), ["company_id", "company_name"], col,
                             value)
        out[entity] = feed.select("company_id", "company_name", "year",
                                  F.col("is_estimate").cast("int").alias("is_estimate"), value)
    return out


def records_to_bronze(spark: SparkSession, paths: Mapping[str, str], keep_extra: bool = False) -> dict[str, DataFrame]:
    """JSON Lines per entity -> the nine Bronze entities (typed; land them
    with ``write_bronze``).  ``paths`` keys: fund, companies, cashflows,
    history, pipeline, sectors, geo.  ``keep_extra`` lands fields outside the
    fixed tables as further columns (one more pass over the records finds them).

    Row numbers (D14) follow an explicit order, since input position is not
    defined across files: cash flows by parsed quarter, deals by stage, name
    and then all other columns, so that only equal deals could swap ids.
    """
    def read(name: str, fields: Mapping[str, str], extra=()) -> tuple[DataFrame, list[str]]:
        if keep_extra:
            return read_with_extra(spark, paths[name], fields, extra)
        return read_records(spark, paths[name], fields, extra), []

    def flat(name: str, fields: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
        records, more = read(name, fields)
        return flatten(records, {**fields, **{c: c for c in more}}), more

    companies, more = read("companies", COMPANY_FIELDS, (("revenue", YEAR_MAP), ("ebitda", YEAR_MAP)))
    out = companies_to_bronze(companies, more)
    for entity, name, fields in (("fund-metrics", "fund", FUND_FIELDS), ("fund-history", "history", HISTORY_FIELDS),
                                 ("sector-breakdown", "sectors", SECTOR_FIELDS), ("geo-breakdown", "geo", GEO_FIELDS)):
        out[entity] = flat(name, fields)[0]
    cf, more = flat("cashflows", CASHFLOW_FIELDS)
    cf = cf.withColumns({"net_cashflow_m": F.expr("contributions_m + distributions_m"),
                         "_qk": F.expr(QUARTER_KEY)})
    out["cashflows"] = number_rows(cf, "_qk", "row_num", tiebreak=["quarter"]).select(
        "row_num", "quarter", "contributions_m", "distributions_m", "net_cashflow_m", *more)
    deals, more = flat("pipeline", DEAL_FIELDS)
    rest = [c for c in DEAL_FIELDS.values() if c not in ("stage", "name")]
    out["deal-pipeline"] = number_rows(deals, ["stage", "name"], "id", tiebreak=[*rest, *more]).select(
        "id", *DEAL_FIELDS.values(), *more)
    return out

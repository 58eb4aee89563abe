"""Serving queries Q1-Q12: fixed Spark SQL over the Gold tables.

Gold tables are either registered catalog tables (``gold.<name>``) or lazy
DataFrames registered as temporary views; the SQL text is the same.  NULL
placement is always spelled out (Spark sorts NULLs first ascending, the
dashboards expect them last).  Each ORDER BY ends in a unique column, so the
order is deterministic and the range partitioning of the global sort can split
any hot sort value (a stage holding most deals) across tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Sort key for quarter labels: 'YYYYQn' or 'Qn YYYY' parsed to year*10+n
# (chronological), other labels sort after them by text.
QUARTER_KEY = ("CASE WHEN quarter RLIKE '^[0-9]{4}Q[1-4]$' "
               "THEN CAST(substr(quarter, 1, 4) AS INT) * 10 + CAST(substr(quarter, 6, 1) AS INT) "
               "WHEN quarter RLIKE '^Q[1-4] [0-9]{4}$' "
               "THEN CAST(substr(quarter, 4, 4) AS INT) * 10 + CAST(substr(quarter, 2, 1) AS INT) "
               "END")

# The serving queries (view name -> SQL; {t} is the Gold table).
VIEW_SQL = {
    "fund_kpis": "SELECT * FROM {t} ORDER BY ALL LIMIT 1",
    "nav_history": f"SELECT * FROM {{t}} ORDER BY {QUARTER_KEY} ASC NULLS LAST, "
                   "quarter ASC NULLS LAST",
    "cashflow": "SELECT * FROM {t} ORDER BY row_num ASC NULLS LAST",
    "portfolio": "SELECT * FROM {t} ORDER BY fmv DESC NULLS LAST, id ASC NULLS LAST",
    "all_financials": "SELECT * FROM {t} "
                      "ORDER BY company_id ASC NULLS LAST, year ASC NULLS LAST, is_estimate",
    "company_financials": "SELECT * FROM {t} WHERE company_id = :company_id "
                          "ORDER BY year ASC NULLS LAST, is_estimate",
    "sector_allocation": "SELECT * FROM {t} ORDER BY fmv_m DESC NULLS LAST, sector",
    "geo_allocation": "SELECT * FROM {t} ORDER BY fmv_m DESC NULLS LAST, region",
    "pipeline": "SELECT * FROM {t} ORDER BY stage ASC NULLS LAST, "
                "probability DESC NULLS LAST, id ASC NULLS LAST",
    "risk_summary": "SELECT * FROM {t} ORDER BY ALL LIMIT 1",
    "leverage_bands": "SELECT * FROM {t} ORDER BY leverage_band ASC NULLS LAST",
    "moic_bands": "SELECT * FROM {t} ORDER BY moic_band ASC NULLS LAST",
}

VIEW_TABLE = {"fund_kpis": "fund_kpis", "nav_history": "nav_history",
              "cashflow": "cashflow_jcurve", "portfolio": "portfolio_table",
              "all_financials": "company_financials", "company_financials": "company_financials",
              "sector_allocation": "sector_allocation", "geo_allocation": "geo_allocation",
              "pipeline": "pipeline", "risk_summary": "risk_summary",
              "leverage_bands": "risk_leverage_bands", "moic_bands": "risk_moic_bands"}


def serve(spark: SparkSession, view: str, tables: Mapping[str, DataFrame] | None = None,
          database: str | None = None, company_id: int | None = None) -> DataFrame:
    """Run serving query ``view``.

    ``tables`` maps Gold names to DataFrames: the one needed is registered
    under a unique temporary name for the analysis of the statement and
    dropped again (the returned DataFrame keeps its plan).  Otherwise the
    table is read as ``<database>.<name>`` from the catalog.  ``company_id``
    must be a positive integer (an empty result means "not found").
    """
    args = None
    if view == "company_financials":
        if not isinstance(company_id, int) or isinstance(company_id, bool) or company_id <= 0:
            raise ValueError("company_id must be a positive integer")
        args = {"company_id": company_id}
    name = VIEW_TABLE[view]
    if tables is not None:
        temp = f"_fundlake_{name}_{uuid.uuid4().hex[:8]}"
        tables[name].createOrReplaceTempView(temp)
        try:
            return spark.sql(VIEW_SQL[view].replace("{t}", temp), args=args)
        finally:
            spark.catalog.dropTempView(temp)
    if database is None:
        raise ValueError("give either tables or database")
    return spark.sql(VIEW_SQL[view].replace("{t}", f"`{database}`.`{name}`"), args=args)


def create_views(spark: SparkSession, database: str = "gold", prefix: str = "q_") -> list[str]:
    """Register the parameterless serving statements as catalog views
    ``<database>.<prefix><view>`` over the Gold tables of that database, so
    SQL users query them directly.  The one-company lookup keeps its
    parameter and stays a call to :func:`serve`."""
    names = []
    for view, sql in VIEW_SQL.items():
        if ":company_id" in sql:
            continue
        name = f"`{database}`.`{prefix}{view}`"
        body = sql.replace("{t}", f"`{database}`.`{VIEW_TABLE[view]}`")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
        names.append(f"{database}.{prefix}{view}")
    return names

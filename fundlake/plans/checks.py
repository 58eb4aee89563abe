"""Rules of the Silver tables, for ``run_silver(..., rules=silver_rules)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from fundlake.operators.validation import Rule, in_range, present, refers, row_change, unique

# A table may at most halve or double from one run to the next.
LOW, HIGH = 0.5, 2.0


def silver_rules(frames: Mapping[str, DataFrame], rows_before: Mapping[str, int]) -> dict[str, Sequence[Rule]]:
    """Rules by table; ``frames`` are the tables of this run, ``rows_before`` the row counts of the version before."""
    def change(table: str) -> Rule:
        return row_change(rows_before.get(table), LOW, HIGH)

    return {
        "portfolio_companies": [present("id"), unique(["id"]), in_range("ownership_pct", 0.0, 100.0), in_range("invested_capital", 0.0),
                                in_range("entry_year", 1900, 2200), change("portfolio_companies")],
        "company_financials": [present("company_id"), present("year"), unique(["company_id", "year", "is_estimate"]),
                               refers(["company_id"], frames["portfolio_companies"], ["id"]), in_range("year", 1900, 2200),
                               change("company_financials")],
        "deal_pipeline": [unique(["id"]), in_range("probability", 0.0, 100.0), change("deal_pipeline")],
        "sector_breakdown": [unique(["sector"]), in_range("portfolio_pct", 0.0, 100.0)],
        "geo_breakdown": [unique(["region"])],
        "fund_history": [unique(["quarter"]), change("fund_history")],
    }

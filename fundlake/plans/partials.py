"""G1 and G9 from stored states: each delivery of companies is summed up once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fundlake.operators import attach_scalar, hhi
from fundlake.operators.mergeable import Grouping, PartialStats, count, highest, mean, total, weighted
from fundlake.plans.gold import ACTIVE, WATCH

KPIS = (total("total_fmv_m", "fmv"), total("total_invested_m", "invested_capital"),
        count("active_companies", f"status = '{ACTIVE}'"), count("watch_companies", f"status = '{WATCH}'"))
RISK = (mean("avg_net_leverage_x", "net_leverage_x"), highest("max_net_leverage_x", "net_leverage_x", 2),
        weighted("weighted_avg_moic", "moic", "fmv"), weighted("weighted_avg_irr", "irr", "fmv"),
        count("active_count", f"status = '{ACTIVE}'"), count("watch_count", f"status = '{WATCH}'"))
FMV = (total("fmv_m", "fmv"),)


def portfolio_states(root: str, parts: Sequence[str]) -> PartialStats:
    """The store behind :func:`fund_kpis` and :func:`risk_summary`; ``update`` it with rows of ``portfolio_companies``."""
    return PartialStats(root, tuple(parts), {"portfolio": Grouping(KPIS + RISK), "sector": Grouping(FMV, ("sector",)),
                                             "geography": Grouping(FMV, ("geography",))})


def fund_kpis(spark: SparkSession, states: PartialStats, fm: DataFrame, where: str | None = None) -> DataFrame:
    """G1 as :func:`fundlake.plans.gold.fund_kpis`, without the companies' rows."""
    return attach_scalar(fm, states.result(spark, "portfolio", where).select(*[s.name for s in KPIS]))


def risk_summary(spark: SparkSession, states: PartialStats, where: str | None = None) -> DataFrame:
    """G9 as :func:`fundlake.plans.gold.risk_summary` over breakdowns by sector and geography, without the companies' rows."""
    sectors = hhi(states.result(spark, "sector", where), "fmv_m", "hhi_sector")
    regions = hhi(states.result(spark, "geography", where), "fmv_m", "hhi_geo")
    stats = states.result(spark, "portfolio", where).select(*[s.name for s in RISK])
    return attach_scalar(attach_scalar(sectors, regions), stats)

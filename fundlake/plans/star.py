"""Fund relations derived from the driver's star tables.

The lake has no fund data of its own in the test environment, so the Bronze
entities are derived from ``customer``/``orders``/``lineitem``/``nation``/
``region``/``events``.  Every relation is a Spark plan over the whole tables,
so its work grows with them.  Heavy inputs are aggregated before any join
(orders per customer, lineitem per order), which collapses a hot key on the
map side before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.numeric import sql_round, sql_sum
from fundlake.operators import number_rows, weights
from fundlake.session import fresh_dir, materialize

# Fixed values of the adapter (not of the engine).
STAR_AS_OF_YEAR = 2002          # test data ends in 2001
ESTIMATE_FROM_YEAR = 2001       # the last, partial year is treated as an estimate
DEBT_PRIORITIES = ("1-URGENT", "2-HIGH")
FUND_LITERALS = {"fund_name": "Star Fund I", "short_name": "SF-I", "strategy": "Buyout",
                 "geography": "Global"}
FUND_TERMS = {"management_fee_pct": 2.0, "carry_pct": 20.0, "hurdle_rate_pct": 8.0}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")


def _when_status(status: str) -> str:
    return f"CASE WHEN o_orderstatus = '{status}' THEN o_totalprice END"


def _sum_as(x: str, name: str):
    return F.expr(f"{sql_sum(x)} AS {name}")


def holdings(spark: SparkSession, sf_dir: str, as_of_year: int = STAR_AS_OF_YEAR) -> DataFrame:
    """Bronze-shaped ``portfolio_companies`` (typed): one holding per customer.

    invested = F orders, fmv = O orders, realized = P orders (0 if none),
    debt = urgent/high-priority orders, EBITDA from the account balance,
    status Watch / Exited / Active by key digit.
    """
    debt_in = ", ".join(f"'{p}'" for p in DEBT_PRIORITIES)
    per_cust = _orders(spark, sf_dir).groupBy("o_custkey").agg(
        F.expr("CAST(min(year(o_orderdate)) AS INT) AS entry_year"),
        _sum_as(_when_status("F"), "invested_capital"), _sum_as(_when_status("O"), "fmv"),
        _sum_as(_when_status("P"), "realized"),
        _sum_as(f"CASE WHEN o_orderpriority IN ({debt_in}) THEN o_totalprice END", "debt"),
        F.expr("count(1) AS n_orders"), F.expr("min(o_totalprice) AS min_price"),
        F.expr("max(o_totalprice) AS max_price"))
    # nation (25 rows) and region (5 rows) are fixed-size dimension tables.
    geo = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = table(spark, sf_dir, "customer").join(
        F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    h = cust.join(per_cust, F.col("c_custkey") == F.col("o_custkey"), "left")
    realized = "coalesce(realized, 0.0D)"
    moic = f"try_divide(fmv + {realized}, invested_capital)"
    years = f"CAST({int(as_of_year)} - entry_year AS DOUBLE)"
    irr = sql_round(f"(pow({moic}, 1.0D / {years}) - 1) * 100", 2)
    return h.selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS sector", "n_name AS subsector",
        "r_name AS geography", "entry_year", "min_price * 10 AS entry_ev",
        "c_acctbal * 40 AS entry_ebitda", "min_price / 10000 AS entry_multiple",
        "invested_capital", "CAST(c_nationkey AS DOUBLE) * 4 AS ownership_pct",
        "max_price * 10 AS current_ev", "c_acctbal * 50 AS current_ebitda",
        "max_price / 10000 AS current_multiple", "fmv", f"{moic} AS moic", f"{irr} AS irr",
        "CASE WHEN c_custkey % 10 = 0 THEN 'Watch' WHEN c_custkey % 10 = 5 THEN 'Exited' "
        "ELSE 'Active' END AS status",
        "debt", "CAST(n_orders * 10 AS INT) AS employees",
        "concat_ws(' / ', c_mktsegment, n_name) AS description", f"{realized} AS realized")


def _year(c="o_orderdate"):
    return F.expr(f"CAST(year({c}) AS INT)")


def _orders_of(spark, sf_dir, companies: DataFrame | None) -> DataFrame:
    """Orders, optionally restricted to ``companies`` (a one-column DataFrame
    of customer keys).  A restriction is written to the shared folder, so that
    what follows is planned with its true size."""
    o = _orders(spark, sf_dir)
    if companies is None:
        return o
    keys = companies.select(F.col(companies.columns[0]).alias("o_custkey"))
    path = fresh_dir(spark, "orders-of")
    o.join(keys, "o_custkey", "left_semi").write.parquet(path)
    return spark.read.parquet(path)


def revenue(spark: SparkSession, sf_dir: str, estimate_from: int = ESTIMATE_FROM_YEAR,
            companies: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped revenue feed: order value per (customer, year).
    ``companies`` restricts the feed before any aggregation."""
    rev = _orders_of(spark, sf_dir, companies).groupBy(
        F.col("o_custkey").alias("company_id"), _year().alias("year")
    ).agg(_sum_as("o_totalprice", "revenue_m"))
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"))
    return rev.join(names, "company_id", "left").selectExpr(
        "company_id", "company_name", "year", f"year >= {int(estimate_from)} AS is_estimate",
        "revenue_m")


def ebitda(spark: SparkSession, sf_dir: str, estimate_from: int = ESTIMATE_FROM_YEAR,
           with_name: bool = False, companies: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped EBITDA feed: discount value per (customer, year).

    lineitem is summed per order first, then joined 1:1 to
    orders: the big join moves one row per order, not one per line.  With
    ``companies``, lines of other companies' orders go before the sum.
    """
    orders, lines = _orders_of(spark, sf_dir, companies), table(spark, sf_dir, "lineitem")
    if companies is not None:
        lines = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    per_order = lines.groupBy("l_orderkey").agg(
        _sum_as("l_extendedprice * l_discount", "d"))
    eb = (orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
          .groupBy(F.col("o_custkey").alias("company_id"), _year().alias("year"))
          .agg(_sum_as("d", "ebitda_m")))
    cols = ["company_id", "year", f"year >= {int(estimate_from)} AS is_estimate", "ebitda_m"]
    if with_name:
        names = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"))
        eb = eb.join(names, "company_id", "left")
        cols.insert(1, "company_name")
    return eb.selectExpr(*cols)


def _quarterly(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    return o.groupBy(_year().alias("_y"), F.expr("CAST(quarter(o_orderdate) AS INT) AS _q")).agg(
        _sum_as(_when_status("F"), "_f"), _sum_as(_when_status("O"), "_o"),
        _sum_as(_when_status("P"), "_p"), _sum_as("o_totalprice", "_all"),
        _sum_as("CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice END", "_op"))


_QUARTER_LABEL = "concat(CAST(_y AS STRING), 'Q', CAST(_q AS STRING))"


def cashflows(spark: SparkSession, sf_dir: str, quarterly: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped cashflows: per quarter, contributions (-F), distributions
    (+O), net; ``row_num`` numbers quarters in calendar order (D14)."""
    # one row per quarter: numbering reads it several times
    q = materialize(_quarterly(spark, sf_dir)) if quarterly is None else quarterly
    contrib, dist = "(0.0D - coalesce(_f, 0.0D))", "coalesce(_o, 0.0D)"
    cf = q.selectExpr("_y", "_q", f"{_QUARTER_LABEL} AS quarter",
                      f"{contrib} AS contributions_m", f"{dist} AS distributions_m",
                      f"{contrib} + {dist} AS net_cashflow_m")
    cf = materialize(number_rows(cf, ["_y", "_q"], "row_num"))
    return cf.select("row_num", "quarter", "contributions_m", "distributions_m",
                     "net_cashflow_m")


def fund_history(spark: SparkSession, sf_dir: str, quarterly: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped fund history: NAV, IRR proxy and TVPI per quarter (of ``quarterly``, if it is there already)."""
    q = _quarterly(spark, sf_dir) if quarterly is None else quarterly
    return q.selectExpr(
        f"{_QUARTER_LABEL} AS quarter", "_all AS nav_m",
        f"{sql_round('try_divide(_p, _all) * 100', 2)} AS net_irr",
        f"{sql_round('try_divide(_op, _f)', 2)} AS tvpi")


def fund_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped fund metrics: one row aggregated over all orders."""
    o = _orders(spark, sf_dir)
    a = o.agg(
        F.expr("CAST(min(year(o_orderdate)) AS INT) AS vintage"),
        _sum_as("o_totalprice", "committed_capital"),
        _sum_as("CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice END", "called_capital"),
        _sum_as(_when_status("F"), "distributions"), _sum_as(_when_status("O"), "nav"),
        _sum_as(_when_status("P"), "_p"),
        F.expr("CAST(count(DISTINCT o_custkey) AS INT) AS num_portcos"),
        F.expr("to_date(max(o_orderdate)) AS as_of_date"))
    tv = "(distributions + nav)"

    def r2(x):
        return sql_round(x, 2)
    lits = [f"'{v}' AS {k}" for k, v in FUND_LITERALS.items()]
    return a.selectExpr(
        lits[0], lits[1], "vintage", lits[2], lits[3], "committed_capital", "called_capital",
        f"{r2('committed_capital - called_capital')} AS uncalled_capital",
        "distributions", "nav", f"{tv} AS total_value",
        f"{r2(f'try_divide({tv}, called_capital)')} AS tvpi",
        f"{r2('try_divide(distributions, called_capital)')} AS dpi",
        f"{r2('try_divide(nav, called_capital)')} AS rvpi",
        f"{r2('try_divide(_p, committed_capital) * 100')} AS net_irr",
        f"{r2('try_divide(_p, called_capital) * 100')} AS gross_irr",
        f"{r2(f'try_divide({tv}, called_capital)')} AS moic",
        *[f"{float(v)!r}D AS {k}" for k, v in FUND_TERMS.items()],
        "num_portcos", "as_of_date")


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped deal pipeline: one deal per order, stage = priority,
    probability = order key mod 101 (percent)."""
    o = _orders(spark, sf_dir)
    return o.selectExpr(
        "o_orderkey AS id", "concat('Deal ', CAST(o_orderkey AS STRING)) AS name",
        "o_orderstatus AS sector", "o_orderpriority AS subsector", "'orders' AS source",
        "o_orderpriority AS stage", "o_totalprice * 2 AS target_ev_m", "o_totalprice AS equity_m",
        "o_totalprice / 10000 AS ev_ebitda", "CAST(o_orderkey % 101 AS DOUBLE) AS probability",
        "CAST(o_custkey AS STRING) AS owner",
        "concat_ws(' ', o_orderpriority, 'deal') AS description", "CAST(NULL AS STRING) AS notes")


def sector_breakdown(holdings_df: DataFrame) -> DataFrame:
    """Bronze-shaped sector breakdown: FMV and company count per sector."""
    sb = holdings_df.groupBy("sector").agg(
        _sum_as("fmv", "fmv_m"), F.expr("CAST(count(1) AS INT) AS company_count"))
    return weights(sb, "fmv_m", "portfolio_pct", scale=1)


def geo_breakdown(holdings_df: DataFrame) -> DataFrame:
    """Bronze-shaped geography breakdown: FMV and company count per region."""
    return holdings_df.groupBy(F.col("geography").alias("region")).agg(
        _sum_as("fmv", "fmv_m"), F.expr("CAST(count(1) AS INT) AS company_count"))


def flows_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fine-grained flows for the distributed running total: events."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "value")


def bronze_entities(spark: SparkSession, sf_dir: str,
                    as_of_year: int = STAR_AS_OF_YEAR, stored: bool = False) -> dict[str, DataFrame]:
    """All nine Bronze entities (typed; write them with ``write_bronze``).

    ``stored`` computes the holdings, which three entities are made of, once and
    at once: for those who land them all.
    """
    h = holdings(spark, sf_dir, as_of_year)
    if stored:
        h = materialize(h)
    quarterly = materialize(_quarterly(spark, sf_dir))
    return {
        "fund-metrics": fund_metrics(spark, sf_dir),
        "portfolio-companies": h,
        "company-revenue": revenue(spark, sf_dir),
        "company-ebitda": ebitda(spark, sf_dir, with_name=True),
        "cashflows": cashflows(spark, sf_dir, quarterly),
        "fund-history": fund_history(spark, sf_dir, quarterly),
        "deal-pipeline": deals(spark, sf_dir),
        "sector-breakdown": sector_breakdown(h),
        "geo-breakdown": geo_breakdown(h),
    }

"""Independent ANSI-SQL statements (DuckDB dialect) for every registered
query, written from the definitions rather than generated from the Spark
plans.  Sums are exact decimals; rounding is HALF_UP, once, on the shortest
decimal text of the double (Spark's ``round``); a zero divisor gives NULL.
"""

from __future__ import annotations

from fundlake.plans.star import STAR_AS_OF_YEAR, ESTIMATE_FROM_YEAR


def R(x: str, s: int = 2) -> str:
    """Round HALF_UP once, on the shortest decimal text of the double; NaN, inf and huge values as they are."""
    return (f"(CASE WHEN isnan({x}) OR isinf({x}) OR abs({x}) >= 1e15 THEN ({x}) "
            f"ELSE CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {s}) AS DOUBLE) END)")


def D(x: str) -> str:
    """The double as an exact decimal, by its shortest text."""
    return f"TRY_CAST(CAST(CAST(({x}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,12))"


def S(x: str) -> str:
    """Exact sum of a double expression, as double."""
    return f"CAST(SUM({D(x)}) AS DOUBLE)"


def AVG(x: str) -> str:
    return f"({S(x)} / NULLIF(CAST(COUNT({x}) AS DOUBLE), 0))"


def _st(status: str) -> str:
    return f"CASE WHEN o_orderstatus = '{status}' THEN o_totalprice END"


Y = "CAST(year(o_orderdate) AS INTEGER)"

HOLDINGS = f"""
per_cust AS (
  SELECT o_custkey, CAST(MIN(year(o_orderdate)) AS INTEGER) AS entry_year,
         {S(_st('F'))} AS invested_capital, {S(_st('O'))} AS fmv, {S(_st('P'))} AS realized0,
         {S("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END")} AS debt,
         COUNT(*) AS n_orders, MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price
  FROM orders GROUP BY o_custkey),
geo AS (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r
        ON n.n_regionkey = r.r_regionkey),
h0 AS (
  SELECT c.*, g.n_name, g.r_name, p.*, COALESCE(p.realized0, CAST(0 AS DOUBLE)) AS realized
  FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey
  LEFT JOIN per_cust p ON c.c_custkey = p.o_custkey),
holdings AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS sector, n_name AS subsector,
         r_name AS geography, entry_year, min_price * 10 AS entry_ev,
         c_acctbal * 40 AS entry_ebitda, min_price / 10000 AS entry_multiple, invested_capital,
         CAST(c_nationkey AS DOUBLE) * 4 AS ownership_pct, max_price * 10 AS current_ev,
         c_acctbal * 50 AS current_ebitda, max_price / 10000 AS current_multiple, fmv,
         (fmv + realized) / NULLIF(invested_capital, 0) AS moic,
         {R(f"(pow((fmv + realized) / NULLIF(invested_capital, 0), CAST(1 AS DOUBLE) / CAST({STAR_AS_OF_YEAR} - entry_year AS DOUBLE)) - 1) * 100")} AS irr,
         CASE WHEN c_custkey % 10 = 0 THEN 'Watch' WHEN c_custkey % 10 = 5 THEN 'Exited'
              ELSE 'Active' END AS status,
         debt, CAST(n_orders * 10 AS INTEGER) AS employees,
         concat_ws(' / ', c_mktsegment, n_name) AS description, realized
  FROM h0)"""

PORTCO = HOLDINGS + f""",
portco AS (
  SELECT *, {STAR_AS_OF_YEAR} - entry_year AS holding_years,
         {R("current_multiple - entry_multiple")} AS multiple_expansion,
         {R("fmv - invested_capital")} AS gross_value_creation_m,
         {R("fmv + realized")} AS total_value_m,
         CASE WHEN current_ebitda > 0 THEN {R("debt / NULLIF(current_ebitda, 0)")} END
           AS net_leverage_x
  FROM holdings)"""

FEEDS = f"""
rev0 AS (SELECT o_custkey AS company_id, {Y} AS year, {S("o_totalprice")} AS revenue_m
         FROM orders GROUP BY 1, 2),
revenue AS (
  SELECT r.company_id, c.c_name AS company_name, r.year,
         r.year >= {ESTIMATE_FROM_YEAR} AS is_estimate, r.revenue_m
  FROM rev0 r LEFT JOIN customer c ON c.c_custkey = r.company_id),
per_order AS (SELECT l_orderkey,
                     {S("l_extendedprice * l_discount")} AS d
              FROM lineitem GROUP BY l_orderkey),
ebitda AS (
  SELECT o_custkey AS company_id, {Y} AS year, {Y} >= {ESTIMATE_FROM_YEAR} AS is_estimate,
         {S("d")} AS ebitda_m
  FROM orders JOIN per_order ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)"""

FIN0 = FEEDS + f""",
fin0 AS (
  SELECT r.company_id, r.year, r.company_name, r.is_estimate, r.revenue_m, e.ebitda_m,
         CASE WHEN r.revenue_m > 0 THEN {R("e.ebitda_m / NULLIF(r.revenue_m, 0) * 100")} END
           AS ebitda_margin_pct
  FROM revenue r LEFT JOIN ebitda e
    ON r.company_id = e.company_id AND r.year = e.year AND r.is_estimate = e.is_estimate)"""


def _yoy(c: str) -> str:
    prev = f"lag({c}) OVER w"
    return R(f"({c} - {prev}) / NULLIF(abs({prev}), 0) * 100")


FIN = FIN0 + f""",
fin AS (
  SELECT *, {_yoy("revenue_m")} AS revenue_yoy_pct, {_yoy("ebitda_m")} AS ebitda_yoy_pct
  FROM fin0 WINDOW w AS (PARTITION BY company_id ORDER BY year, is_estimate))"""

QTR = f"""
qtr AS (
  SELECT {Y} AS _y, CAST(quarter(o_orderdate) AS INTEGER) AS _q,
         {S(_st('F'))} AS _f, {S(_st('O'))} AS _o, {S(_st('P'))} AS _p,
         {S("o_totalprice")} AS _all,
         {S("CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice END")} AS _op
  FROM orders GROUP BY 1, 2)"""

QLABEL = "CAST(_y AS VARCHAR) || 'Q' || CAST(_q AS VARCHAR)"

CASHFLOWS = QTR + f""",
cf0 AS (
  SELECT _y, _q, {QLABEL} AS quarter,
         CAST(0 AS DOUBLE) - COALESCE(_f, CAST(0 AS DOUBLE)) AS contributions_m,
         COALESCE(_o, CAST(0 AS DOUBLE)) AS distributions_m
  FROM qtr),
cashflows AS (
  SELECT row_number() OVER (ORDER BY _y, _q) AS row_num, quarter, contributions_m,
         distributions_m, contributions_m + distributions_m AS net_cashflow_m
  FROM cf0)"""


def _cum(c: str, w: str = "w") -> str:
    return f"CAST(ROUND(SUM({D(c)}) OVER {w}, 2) AS DOUBLE)"


QCF = CASHFLOWS + f""",
qcf AS (
  SELECT *, {_cum("contributions_m")} AS cum_contributions_m,
         {_cum("distributions_m")} AS cum_distributions_m,
         {_cum("net_cashflow_m")} AS cum_net_cashflow_m
  FROM cashflows
  WINDOW w AS (ORDER BY row_num, quarter ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

FUND_HISTORY = QTR + f""",
fund_history AS (
  SELECT {QLABEL} AS quarter, _all AS nav_m, {R("_p / NULLIF(_all, 0) * 100")} AS net_irr,
         {R("_op / NULLIF(_f, 0)")} AS tvpi
  FROM qtr)"""

FUND_METRICS = f"""
fm0 AS (
  SELECT CAST(MIN(year(o_orderdate)) AS INTEGER) AS vintage,
         {S("o_totalprice")} AS committed_capital,
         {S("CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice END")} AS called_capital,
         {S(_st('F'))} AS distributions, {S(_st('O'))} AS nav, {S(_st('P'))} AS _p,
         CAST(COUNT(DISTINCT o_custkey) AS INTEGER) AS num_portcos,
         CAST(MAX(o_orderdate) AS DATE) AS as_of_date
  FROM orders),
fund_metrics AS (
  SELECT 'Star Fund I' AS fund_name, 'SF-I' AS short_name, vintage, 'Buyout' AS strategy,
         'Global' AS geography, committed_capital, called_capital,
         {R("committed_capital - called_capital")} AS uncalled_capital, distributions, nav,
         distributions + nav AS total_value,
         {R("(distributions + nav) / NULLIF(called_capital, 0)")} AS tvpi,
         {R("distributions / NULLIF(called_capital, 0)")} AS dpi,
         {R("nav / NULLIF(called_capital, 0)")} AS rvpi,
         {R("_p / NULLIF(committed_capital, 0) * 100")} AS net_irr,
         {R("_p / NULLIF(called_capital, 0) * 100")} AS gross_irr,
         {R("(distributions + nav) / NULLIF(called_capital, 0)")} AS moic,
         CAST(2.0 AS DOUBLE) AS management_fee_pct, CAST(20.0 AS DOUBLE) AS carry_pct,
         CAST(8.0 AS DOUBLE) AS hurdle_rate_pct, num_portcos, as_of_date
  FROM fm0),
silver_fm AS (
  SELECT *, {R("called_capital / NULLIF(committed_capital, 0) * 100")} AS deployed_pct,
         {R("nav / NULLIF(total_value, 0) * 100")} AS unrealised_pct
  FROM fund_metrics)"""

DEALS = f"""
deal_pipeline AS (
  SELECT o_orderkey AS id, 'Deal ' || CAST(o_orderkey AS VARCHAR) AS name,
         o_orderstatus AS sector, o_orderpriority AS subsector, 'orders' AS source,
         o_orderpriority AS stage, o_totalprice * 2 AS target_ev_m, o_totalprice AS equity_m,
         o_totalprice / 10000 AS ev_ebitda, CAST(o_orderkey % 101 AS DOUBLE) AS probability,
         CAST(o_custkey AS VARCHAR) AS owner, concat_ws(' ', o_orderpriority, 'deal') AS description,
         CAST(NULL AS VARCHAR) AS notes,
         {R("o_totalprice * CAST(o_orderkey % 101 AS DOUBLE) / 100")} AS weighted_equity_m
  FROM orders),
stage_agg AS (
  SELECT stage, COUNT(*) AS stage_count, {R(S("equity_m"))} AS stage_equity_m,
         {R(S("weighted_equity_m"))} AS stage_weighted_m, {R(AVG("probability"), 1)} AS stage_avg_prob
  FROM deal_pipeline GROUP BY stage)"""

BREAKDOWNS = f""",
sb0 AS (SELECT sector, {S("fmv")} AS fmv_m, CAST(COUNT(*) AS INTEGER) AS company_count
        FROM holdings GROUP BY sector),
sector_breakdown AS (
  SELECT sector, fmv_m, company_count, {R("fmv_m / NULLIF(t, 0) * 100", 1)} AS portfolio_pct
  FROM sb0, (SELECT {S("fmv_m")} AS t FROM sb0)),
geo_breakdown AS (SELECT geography AS region, {S("fmv")} AS fmv_m,
                         CAST(COUNT(*) AS INTEGER) AS company_count
                  FROM holdings GROUP BY geography)"""


def _alloc(src: str, hhi: str) -> str:
    return f"""
a0_{src} AS (SELECT {src}.*, {R("fmv_m / NULLIF(t, 0) * 100")} AS weight_pct
             FROM {src}, (SELECT {S("fmv_m")} AS t FROM {src})),
a1_{src} AS (SELECT *, {R("pow(weight_pct / 100, 2) * 10000")} AS hhi_contribution
             FROM a0_{src}),
h_{src} AS (SELECT {R(S("hhi_contribution"), 0)} AS {hhi} FROM a1_{src}),
alloc_{src} AS (SELECT a1_{src}.*, h_{src}.{hhi} FROM a1_{src}, h_{src})"""


LATEST = """
latest AS (
  SELECT company_id, year AS latest_fin_year, revenue_m AS latest_revenue_m,
         ebitda_m AS latest_ebitda_m, ebitda_margin_pct AS latest_ebitda_margin_pct,
         revenue_yoy_pct AS latest_revenue_yoy_pct
  FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY year DESC) AS rn
        FROM fin WHERE NOT is_estimate) WHERE rn = 1)"""

CAGR = f"""
cg AS (
  SELECT company_id, MIN(year) AS first_year, MAX(year) AS last_year,
         arg_min(revenue_m, year) FILTER (WHERE revenue_m IS NOT NULL) AS first_value,
         arg_max(revenue_m, year) FILTER (WHERE revenue_m IS NOT NULL) AS last_value
  FROM fin WHERE NOT is_estimate GROUP BY company_id),
cagr AS (
  SELECT *, CASE WHEN first_value > 0 AND last_year - first_year > 0 THEN
         {R("(pow(last_value / first_value, CAST(1 AS DOUBLE) / CAST(last_year - first_year AS DOUBLE)) - 1) * 100")}
         END AS revenue_cagr_pct
  FROM cg),
gold_fin AS (SELECT fin.*, cagr.revenue_cagr_pct FROM fin LEFT JOIN cagr USING (company_id))"""

LEV_BAND = ("CASE WHEN net_leverage_x <= 3.0 THEN '≤3x Conservative' "
            "WHEN net_leverage_x <= 5.0 THEN '3-5x Moderate' "
            "WHEN net_leverage_x <= 7.0 THEN '5-7x Elevated' ELSE '>7x High' END")
MOIC_BAND = ("CASE WHEN moic < 1.0 THEN '<1x Below cost' WHEN moic < 1.5 THEN '1-1.5x Low' "
             "WHEN moic < 2.0 THEN '1.5-2x Moderate' WHEN moic < 3.0 THEN '2-3x Good' "
             "ELSE '≥3x Excellent' END")

RISK_STATS = f"""
risk_stats AS (
  SELECT {R(AVG("net_leverage_x"))} AS avg_net_leverage_x,
         {R("MAX(net_leverage_x)")} AS max_net_leverage_x,
         {R(f'{S("fmv * moic")} / NULLIF({S("fmv")}, 0)')} AS weighted_avg_moic,
         {R(f'{S("fmv * irr")} / NULLIF({S("fmv")}, 0)')} AS weighted_avg_irr,
         COUNT(*) FILTER (WHERE status = 'Active') AS active_count,
         COUNT(*) FILTER (WHERE status = 'Watch') AS watch_count
  FROM portco)"""


def _w(body: str) -> str:
    return "WITH " + body.strip().lstrip(",")


ORACLE_SQL: dict[str, str] = {
    "holding_metrics": _w(PORTCO) + "\nSELECT * FROM portco",
    "bronze_roundtrip": _w(PORTCO) + "\nSELECT * FROM portco",
    "flatten_entities": _w(HOLDINGS) + "\nSELECT * FROM holdings",
    "financial_margins": _w(FIN0) + "\nSELECT * FROM fin0",
    "yoy_growth": _w(FIN) + "\nSELECT * FROM fin",
    "unpivot_years": _w(FEEDS) + "\nSELECT * FROM revenue",
    "running_cashflows": _w(QCF) + "\nSELECT * FROM qcf ORDER BY row_num",
    "running_total_distributed": (
        "SELECT event_id, value, " + _cum("value", "(ORDER BY ts, event_id ROWS BETWEEN "
                                          "UNBOUNDED PRECEDING AND CURRENT ROW)")
        + " AS cum_value FROM events"),
    "number_rows": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_num "
                   "FROM events",
    "nav_history": _w(FUND_HISTORY) + "\nSELECT * FROM fund_history ORDER BY quarter",
    "fund_ratios": _w(FUND_METRICS) + "\nSELECT * FROM silver_fm",
    "fund_kpis": _w(FUND_METRICS + "," + PORTCO) + f"""
SELECT silver_fm.*, k.* FROM silver_fm, (
  SELECT {S("fmv")} AS total_fmv_m, {S("invested_capital")} AS total_invested_m,
         COUNT(*) FILTER (WHERE status = 'Active') AS active_companies,
         COUNT(*) FILTER (WHERE status = 'Watch') AS watch_companies FROM portco) k""",
    "sector_allocation": _w(HOLDINGS + BREAKDOWNS + "," + _alloc("sector_breakdown", "hhi_sector"))
    + "\nSELECT * FROM alloc_sector_breakdown ORDER BY fmv_m DESC",
    "geo_allocation": _w(HOLDINGS + BREAKDOWNS + "," + _alloc("geo_breakdown", "hhi_geo"))
    + "\nSELECT * FROM alloc_geo_breakdown ORDER BY fmv_m DESC",
    "latest_financials": _w(FIN + "," + LATEST) + "\nSELECT * FROM latest",
    "portfolio_table": _w(PORTCO + "," + FIN + "," + LATEST) + """
SELECT p.*, l.latest_fin_year, l.latest_revenue_m, l.latest_ebitda_m,
       l.latest_ebitda_margin_pct, l.latest_revenue_yoy_pct,
       CASE WHEN p.status = 'Watch' THEN 'WATCH' WHEN p.net_leverage_x > 6.0 THEN 'HIGH_LEVERAGE'
            WHEN p.moic < 1.0 THEN 'BELOW_COST' ELSE 'OK' END AS risk_flag
FROM portco p LEFT JOIN latest l ON p.id = l.company_id ORDER BY p.fmv DESC""",
    "revenue_cagr": _w(FIN + "," + CAGR) + "\nSELECT * FROM cagr",
    "company_financials": _w(FIN + "," + CAGR) + "\nSELECT * FROM gold_fin ORDER BY company_id, year",
    "company_financials_by_id": _w(PORTCO + "," + FIN + "," + CAGR) + """
SELECT * FROM gold_fin WHERE company_id = (
  SELECT id FROM portco WHERE fmv IS NOT NULL ORDER BY fmv DESC, id LIMIT 1)
ORDER BY year""",
    "weighted_pipeline": _w(DEALS) + "\nSELECT * FROM deal_pipeline",
    "pipeline_by_stage": _w(DEALS) + "\nSELECT * FROM stage_agg",
    "deal_pipeline": _w(DEALS) + """
SELECT d.*, s.stage_count, s.stage_equity_m, s.stage_weighted_m, s.stage_avg_prob
FROM deal_pipeline d LEFT JOIN stage_agg s ON d.stage = s.stage
ORDER BY d.stage, d.probability DESC""",
    "leverage_bands": _w(PORTCO) + f"""
SELECT {LEV_BAND} AS leverage_band, COUNT(*) AS company_count, {R(S("fmv"))} AS fmv_m
FROM portco GROUP BY 1 ORDER BY 1""",
    "moic_bands": _w(PORTCO) + f"""
SELECT {MOIC_BAND} AS moic_band, COUNT(*) AS company_count, {R(S("fmv"))} AS fmv_m,
       {R(AVG("irr"))} AS avg_irr
FROM portco GROUP BY 1 ORDER BY 1""",
    "leverage_stats": _w(PORTCO) + f"""
SELECT {R(AVG("net_leverage_x"))} AS avg_net_leverage_x,
       {R("MAX(net_leverage_x)")} AS max_net_leverage_x FROM portco""",
    "weighted_returns": _w(PORTCO) + f"""
SELECT {R(f'{S("fmv * moic")} / NULLIF({S("fmv")}, 0)')} AS weighted_avg_moic,
       {R(f'{S("fmv * irr")} / NULLIF({S("fmv")}, 0)')} AS weighted_avg_irr,
       {R(f'{S("fmv * moic")} / NULLIF({S("CASE WHEN moic IS NOT NULL THEN fmv END")}, 0)')}
         AS weighted_avg_moic_drop,
       {R(f'{S("fmv * irr")} / NULLIF({S("CASE WHEN irr IS NOT NULL THEN fmv END")}, 0)')}
         AS weighted_avg_irr_drop
FROM portco""",
    "risk_summary": _w(PORTCO + BREAKDOWNS + "," + _alloc("sector_breakdown", "hhi_sector") + ","
                       + _alloc("geo_breakdown", "hhi_geo") + "," + RISK_STATS) + """
SELECT hs.hhi_sector, hg.hhi_geo, r.* FROM h_sector_breakdown hs, h_geo_breakdown hg,
       risk_stats r""",
    "multiples_check": _w(FUND_METRICS) + f"""
SELECT metric, supplied, recomputed, {R("supplied - recomputed")} AS difference FROM (
  SELECT 'tvpi' AS metric, tvpi AS supplied,
         {R("total_value / NULLIF(called_capital, 0)")} AS recomputed FROM silver_fm
  UNION ALL SELECT 'dpi', dpi, {R("distributions / NULLIF(called_capital, 0)")} FROM silver_fm
  UNION ALL SELECT 'rvpi', rvpi, {R("nav / NULLIF(called_capital, 0)")} FROM silver_fm
  UNION ALL SELECT 'moic', moic, {R("total_value / NULLIF(called_capital, 0)")} FROM silver_fm)""",
}


def _cast_report_sql() -> str:
    from fundlake import schemas
    parts = []
    for f in schemas.PORTFOLIO_COMPANIES.fields:
        t = f.dataType.simpleString()
        if t == "string":
            continue
        parts.append(f"SELECT '{f.name}' AS column_name, '{t}' AS target_type, "
                     f"COUNT(*) AS total_rows, COUNT({f.name}) AS present_rows, "
                     f"CAST(0 AS BIGINT) AS rejected_rows FROM holdings")
    return _w(HOLDINGS) + "\n" + "\nUNION ALL ".join(parts)


ORACLE_SQL["cast_rejects"] = _cast_report_sql()


def _infer_sql() -> str:
    from fundlake import schemas
    kinds = {"bigint": "bigint", "int": "bigint", "double": "double", "boolean": "boolean",
             "string": "string"}
    parts = []
    for f in schemas.PORTFOLIO_COMPANIES.fields:
        t = kinds[f.dataType.simpleString()]
        # A typed column's text reads back as its own kind when it has values;
        # string columns stay text unless every value looks numeric.
        if t == "string":
            kind = (f"CASE WHEN COUNT({f.name}) = 0 THEN 'string' "
                    f"WHEN COUNT(*) FILTER (WHERE {f.name} IS NOT NULL AND NOT "
                    f"regexp_matches(trim({f.name}), '^[+-]?[0-9]+$')) = 0 THEN 'bigint' "
                    f"WHEN COUNT(*) FILTER (WHERE {f.name} IS NOT NULL AND "
                    f"TRY_CAST({f.name} AS DOUBLE) IS NULL) = 0 THEN 'double' ELSE 'string' END")
        else:
            kind = f"CASE WHEN COUNT({f.name}) = 0 THEN 'string' ELSE '{t}' END"
        parts.append(f"SELECT '{f.name}' AS column_name, {kind} AS inferred_type, "
                     f"COUNT({f.name}) AS present_rows FROM holdings")
    return _w(HOLDINGS) + "\n" + "\nUNION ALL ".join(parts)


ORACLE_SQL["infer_types"] = _infer_sql()


def _decode_sql() -> str:
    from fundlake import schemas
    cols = []
    for f in schemas.PORTFOLIO_COMPANIES.fields:
        t = f.dataType.simpleString()
        # text of an int column reads back as bigint, of a double as double
        cols.append(f"CAST({f.name} AS BIGINT) AS {f.name}" if t in ("int", "bigint")
                    else f.name)
    return _w(HOLDINGS) + "\nSELECT " + ", ".join(cols) + " FROM holdings"


ORACLE_SQL["decode_text"] = _decode_sql()

ORACLE_SQL["flatten_json_events"] = (
    "SELECT event_id, user_id, event_type, "
    "CAST(json_extract(props, '$.k') AS INTEGER) AS props_k FROM events")

ORACLE_SQL["company_by_literal_id"] = (
    _w(FIN + "," + CAGR) + "\nSELECT * FROM gold_fin WHERE company_id = 1 ORDER BY year")

# Silver tables from CSV text hold the same rows as from typed input.
_SILVER = {
    "company_financials": ORACLE_SQL["yoy_growth"],
    "quarterly_cashflows": ORACLE_SQL["running_cashflows"],
    "fund_history": ORACLE_SQL["nav_history"],
    "fund_metrics": ORACLE_SQL["fund_ratios"],
    "deal_pipeline": ORACLE_SQL["weighted_pipeline"],
    "sector_breakdown": _w(HOLDINGS + BREAKDOWNS) + "\nSELECT * FROM sector_breakdown",
    "geo_breakdown": _w(HOLDINGS + BREAKDOWNS) + "\nSELECT * FROM geo_breakdown",
}
ORACLE_SQL.update({f"text_{t}": sql for t, sql in _SILVER.items()})

_GOLD = {
    "fund_kpis": "fund_kpis", "nav_history": "nav_history", "cashflow_jcurve": "running_cashflows",
    "sector_allocation": "sector_allocation", "geo_allocation": "geo_allocation",
    "portfolio_table": "portfolio_table", "company_financials": "company_financials",
    "pipeline": "deal_pipeline", "risk_summary": "risk_summary",
    "risk_leverage_bands": "leverage_bands", "risk_moic_bands": "moic_bands"}


def _count_sql(layer: str, table: str, sql: str) -> str:
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS reported_rows, "
            f"count(*) AS read_rows FROM ({sql})")


ORACLE_SQL["portfolio_copartitioned"] = ORACLE_SQL["portfolio_table"]
ORACLE_SQL["financials_copartitioned"] = ORACLE_SQL["company_financials"]

ORACLE_SQL["layers_roundtrip"] = "\nUNION ALL ".join(
    [_count_sql("silver", t, q) for t, q in {**_SILVER, "portfolio_companies":
                                             ORACLE_SQL["holding_metrics"]}.items()]
    + [_count_sql("gold", t, ORACLE_SQL[key]) for t, key in _GOLD.items()])

# A company whose first and last nonzero net flows differ in sign has a rate.
ORACLE_SQL["irr_check"] = f"""
WITH net AS (
  SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d,
         {S("CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END")} AS amount
  FROM orders GROUP BY 1, 2),
ends AS (
  SELECT k, count(*) AS n_flows, min(d) AS first_date, max(d) AS last_date,
         arg_min(amount, d) FILTER (WHERE amount <> 0) AS a,
         arg_max(amount, d) FILTER (WHERE amount <> 0) AS z FROM net GROUP BY k)
SELECT k AS company_id, n_flows, first_date, last_date, TRUE AS solved FROM ends
WHERE sign(a) <> sign(z)"""


def _corrupted_sql() -> str:
    from fundlake import schemas
    bad = "count(*) FILTER (WHERE id % 10 = 3)"
    parts = []
    for f in schemas.PORTFOLIO_COMPANIES.fields:
        t = f.dataType.simpleString()
        if t == "string":
            continue
        # a constant replaces NULLs too, an appended letter leaves them NULL
        if f.name in ("employees", "entry_year"):
            present, rejected = f"count(*) FILTER (WHERE id % 10 = 3 OR {f.name} IS NOT NULL)", bad
        elif f.name == "fmv":
            present, rejected = "count(fmv)", "count(fmv) FILTER (WHERE id % 10 = 3)"
        else:
            present, rejected = f"count({f.name})", "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{f.name}' AS column_name, '{t}' AS target_type, count(*) AS total_rows, "
                     f"{present} AS present_rows, {rejected} AS rejected_rows FROM holdings")
    return _w(HOLDINGS) + "\n" + "\nUNION ALL ".join(parts)


ORACLE_SQL["cast_rejects_corrupted"] = _corrupted_sql()

ORACLE_SQL["seeds_to_bronze"] = _w(FEEDS) + """
SELECT company_id, company_name, year, CAST(is_estimate AS INTEGER) AS is_estimate, revenue_m
FROM revenue WHERE revenue_m IS NOT NULL"""


def _order_sql() -> str:
    orders = {
        "nav_history": ("nav_history", "quarter", "quarter"),
        "cashflow": ("running_cashflows", "quarter", "row_num"),
        "portfolio": ("portfolio_table", "id", "fmv DESC NULLS LAST, id"),
        "sector_allocation": ("sector_allocation", "sector", "fmv_m DESC NULLS LAST, sector"),
        "geo_allocation": ("geo_allocation", "region", "fmv_m DESC NULLS LAST, region"),
        "pipeline": ("deal_pipeline", "id", "stage NULLS LAST, probability DESC NULLS LAST, id"),
        "all_financials": ("company_financials", "concat_ws(' ', company_id, year)", "company_id, year, is_estimate"),
        "leverage_bands": ("leverage_bands", "leverage_band", "leverage_band"),
        "moic_bands": ("moic_bands", "moic_band", "moic_band")}
    return "\nUNION ALL ".join(
        f"SELECT '{view}' AS view, CAST({key} AS VARCHAR) AS row_key, row_number() OVER (ORDER BY {order}) AS position "
        f"FROM ({ORACLE_SQL[name]})" for view, (name, key, order) in orders.items())


ORACLE_SQL["served_order"] = _order_sql()


ORACLE_SQL["registered_two_headers"] = _w(DEALS) + """
SELECT '2002-01-01' AS load_date, CAST(id AS VARCHAR) AS id, stage, equity_m, owner, notes, CAST(NULL AS VARCHAR) AS desk FROM deal_pipeline
UNION ALL SELECT '2002-02-01', CAST(id AS VARCHAR) || 'D', stage, equity_m, owner, NULL, owner FROM deal_pipeline"""
ORACLE_SQL["schema_drift"] = """
SELECT '2002-02-01' AS load_date, * FROM (VALUES ('desk', 'added', NULL, 'bigint'), ('id', 'retyped', 'bigint', 'string'),
  ('notes', 'removed', NULL, NULL)) AS t(column_name, change, old_type, new_type) WHERE EXISTS (SELECT 1 FROM orders)"""
ORACLE_SQL["decode_codes"] = """
SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'f' END AS code,
       '0x' || CAST(o_orderkey AS VARCHAR) AS hex, o_totalprice AS price FROM orders"""
ORACLE_SQL["quoted_text"] = """
SELECT o_orderkey AS id, '"' || o_orderpriority || '", ' || o_orderstatus || chr(10) || CAST(o_custkey AS VARCHAR) AS name FROM orders"""
ORACLE_SQL["backfill_cashflows"] = f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date, event_id AS row_num, {_cum("value")} AS cum_contributions_m,
       {_cum("-value")} AS cum_distributions_m, {_cum("value / 2")} AS cum_net_cashflow_m
FROM events WINDOW w AS (PARTITION BY CAST(ts AS DATE) ORDER BY event_id ROWS UNBOUNDED PRECEDING)"""
ORACLE_SQL["running_total_increments"] = ORACLE_SQL["running_total_distributed"]
ORACLE_SQL["company_unknown_id"] = f"SELECT * FROM ({ORACLE_SQL['company_by_literal_id']}) WHERE company_id < 0"
ORACLE_SQL["multiples_check_perturbed"] = f"""
SELECT metric, s AS supplied, recomputed, {R("s - recomputed")} AS difference FROM (
  SELECT metric, recomputed, CASE metric WHEN 'tvpi' THEN supplied + 0.25 WHEN 'dpi' THEN supplied - 0.5 WHEN 'moic' THEN supplied END AS s
  FROM ({ORACLE_SQL['multiples_check']}))"""
ORACLE_SQL["served_page"] = f"""
SELECT position, id, fmv FROM (
  SELECT row_number() OVER (ORDER BY fmv DESC NULLS LAST, id) AS position, id, fmv FROM ({ORACLE_SQL['portfolio_table']}))
WHERE position BETWEEN 101 AND 150"""

ORACLE_SQL["kpis_from_states"] = ORACLE_SQL["fund_kpis"]
ORACLE_SQL["risk_from_states"] = ORACLE_SQL["risk_summary"]

_JUDGED = _w(FEEDS + """,
s0 AS (
  SELECT CASE WHEN company_id % 10 = 5 THEN company_id + 1000000000000 ELSE company_id END AS company_id,
         CASE WHEN company_id % 10 <> 7 THEN company_name END AS company_name,
         CASE WHEN company_id % 10 = 3 THEN year + 1000 ELSE year END AS year, is_estimate,
         CASE WHEN company_id % 10 = 4 THEN -revenue_m ELSE revenue_m END AS revenue_m FROM revenue),
spoilt AS (SELECT * FROM s0 UNION ALL SELECT * FROM s0 WHERE company_id % 10 = 6),
judged AS (
  SELECT *, year NOT BETWEEN 1900 AND 2100 AS f1, revenue_m < 0 AS f2, company_name IS NULL AS f3,
         count(*) OVER (PARTITION BY company_id, year, is_estimate) > 1 AS f4,
         company_id NOT IN (SELECT c_custkey FROM customer) AS f5 FROM spoilt)""")
_RULES = {"f1": "year_in_range", "f2": "revenue_m_in_range", "f3": "company_name_present", "f4": "one_row", "f5": "company_id_known"}
ORACLE_SQL["validated_feed"] = _JUDGED + "\n" + "\nUNION ALL ".join(
    [f"SELECT '{rule}' AS rule, count(*) AS checked_rows, count(*) FILTER (WHERE {f}) AS failed_rows, "
     f"count(*) FILTER (WHERE {f}) = 0 AS passed FROM judged" for f, rule in _RULES.items()]
    + ["SELECT 'row_change', count(*), CAST(0 AS BIGINT), count(*) BETWEEN 0.95 * (SELECT count(*) FROM revenue) "
       "AND 1.05 * (SELECT count(*) FROM revenue) FROM judged"])
ORACLE_SQL["quarantined_feed"] = _JUDGED + """
SELECT company_id, company_name, year, is_estimate, revenue_m, concat_ws(',', """ + ", ".join(
    f"CASE WHEN {f} THEN '{rule}' END" for f, rule in _RULES.items()) + """) AS failed
FROM judged WHERE """ + " OR ".join(_RULES)

ORACLE_SQL["irr_roots_constructed"] = """
WITH known AS (
  SELECT c_custkey, CASE c_custkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS n, c_custkey % 20 + 1 AS first FROM customer)
SELECT c_custkey AS company_id, CAST(n AS BIGINT) AS sign_changes, CAST(n AS BIGINT) AS n_roots, CAST(0 AS BIGINT) AS unresolved,
       CAST(first AS DOUBLE) AS irr_pct, root_no, CAST(first + added AS DOUBLE) AS root_pct
FROM known JOIN (VALUES (0, 0), (1, 25), (2, 60)) AS r(root_no, added) ON root_no < n"""
ORACLE_SQL["irr_root_parity"] = f"""
WITH net AS (
  SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d,
         {S("CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END")} AS amount
  FROM orders GROUP BY 1, 2),
turns AS (SELECT k, sign(amount) <> lag(sign(amount)) OVER (PARTITION BY k ORDER BY d) AS turn FROM net WHERE amount <> 0)
SELECT k AS company_id, (SELECT count(*) FROM turns t WHERE t.k = n.k AND turn) AS sign_changes, TRUE AS bounded, TRUE AS parity, TRUE AS has_rate
FROM (SELECT DISTINCT k FROM net) n"""

ORACLE_SQL["seeds_extra_keys"] = _w(HOLDINGS) + """
SELECT id, status, CASE WHEN id % 3 = 0 THEN id % 100 END AS esg_score,
       CASE WHEN id % 4 = 1 THEN '{"chair":"' || name || '","n":' || CAST(id % 9 AS VARCHAR) || '}' END AS board,
       CASE WHEN id % 2 = 0 THEN CAST(id AS VARCHAR) ELSE '"R' || CAST(id AS VARCHAR) || '"' END AS deal_ref,
       id / 4.0::DOUBLE + 0.125 AS drift_rate FROM holdings"""
ORACLE_SQL["seeds_extra_fields"] = """
SELECT * FROM (
  SELECT 'esgScore' AS field, 'bigint' AS type, count(*) FILTER (WHERE c_custkey % 3 = 0) AS present FROM customer
  UNION ALL SELECT 'board', 'json', count(*) FILTER (WHERE c_custkey % 4 = 1) FROM customer
  UNION ALL SELECT 'dealRef', 'json', count(*) FROM customer
  UNION ALL SELECT 'driftRate', 'double', count(*) FROM customer) WHERE present > 0"""
ORACLE_SQL["company_by_name"] = _w(FIN + "," + CAGR) + "\nSELECT * FROM gold_fin WHERE company_name = 'Customer#000000007'"

"""Registered queries: one per operator group of the inventory.

Each entry takes ``(spark, sf_dir)``, reads the driver's tables under
``sf_dir`` (whole tables) and returns a lazy DataFrame whose column names
match the oracle statement of the same key.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake import schemas
from fundlake.functions.numeric import sql_avg, sql_round
from fundlake.operators import (cagr, cast_report, flatten, global_stats, irr, irr_check, multiples_check,
                                number_rows, running_total, unpivot_years, weighted_mean)
from fundlake.plans import etl, gold, pages, partials, seeds, silver, star, views
from fundlake.operators.increment import RunningTotals
from fundlake.operators.roots import irr_roots
from fundlake.operators.validation import FAILED, Validation, in_range, present, refers, row_change, unique, validate
from fundlake.plans.backfill import SILVER_SOURCES, backfill
from fundlake.session import fresh_dir, materialize
from fundlake.sources import (LayerRun, create_layers, decode, drift, infer_types, layouts, read_bronze, read_dates, register_table,
                              types_by_date, variants, write_bronze, write_bronze_all, write_drops)

AS_OF = star.STAR_AS_OF_YEAR


def _portco(spark, sf):
    return silver.portfolio_companies(star.holdings(spark, sf, AS_OF), AS_OF)


def _fin(spark, sf):
    return silver.company_financials(star.revenue(spark, sf), star.ebitda(spark, sf))


def _sb(spark, sf):
    # the two-pass HHI reads the breakdown twice: compute it once
    return materialize(silver.sector_breakdown(star.sector_breakdown(
        star.holdings(spark, sf, AS_OF))))


def _gb(spark, sf):
    return materialize(silver.geo_breakdown(star.geo_breakdown(star.holdings(spark, sf, AS_OF))))


def _pl(spark, sf):
    return silver.deal_pipeline(star.deals(spark, sf))


def _fm(spark, sf):
    return silver.fund_metrics(star.fund_metrics(spark, sf))


# -- Silver-level operators -------------------------------------------------

def holding_metrics(spark, sf):
    """D1-D5, C4."""
    return _portco(spark, sf)


def financial_margins(spark, sf):
    """J1 + D6 (the window columns are pruned by Catalyst)."""
    return _fin(spark, sf).select("company_id", "year", "company_name", "is_estimate",
                                  "revenue_m", "ebitda_m", "ebitda_margin_pct")


def yoy_growth(spark, sf):
    """W1, W2."""
    return _fin(spark, sf)


def running_cashflows(spark, sf):
    """W3 + O2 + D10 (distributed prefix sums)."""
    cf = silver.quarterly_cashflows(star.cashflows(spark, sf))
    return views.serve(spark, "cashflow", {"cashflow_jcurve": gold.cashflow_jcurve(cf)})


def running_total_distributed(spark, sf):
    """H1 at row level: running sum of every event's value in (ts, event_id) order."""
    res = running_total(star.flows_fine(spark, sf), "ts", ["value"], tiebreak=["event_id"],
                        out=["cum_value"])
    return res.select("event_id", "value", "cum_value")


def number_rows_(spark, sf):
    """1-based position of every event in (ts, event_id) order."""
    ev = star.table(spark, sf, "events").select("event_id", "ts")
    return number_rows(ev, "ts", "row_num", tiebreak=["event_id"]).select("event_id", "row_num")


def fund_ratios(spark, sf):
    """T5: D7, D8."""
    return _fm(spark, sf)


def weighted_pipeline(spark, sf):
    """D9."""
    return _pl(spark, sf)


# -- Gold tables through the serving SQL -------------------------------------

def nav_history(spark, sf):
    """T4 / G2 / Q2."""
    fh = silver.fund_history(star.fund_history(spark, sf))
    return views.serve(spark, "nav_history", {"nav_history": gold.nav_history(fh)})


def fund_kpis(spark, sf):
    """G1 / Q1: A1, A2, F2, J6, D15."""
    return views.serve(spark, "fund_kpis", {"fund_kpis": gold.fund_kpis(_fm(spark, sf),
                                                                        _portco(spark, sf))})


def sector_allocation(spark, sf):
    """D11, D12, A3, O3."""
    return views.serve(spark, "sector_allocation",
                       {"sector_allocation": gold.sector_allocation(_sb(spark, sf))})


def geo_allocation(spark, sf):
    """G5 / Q8."""
    return views.serve(spark, "geo_allocation",
                       {"geo_allocation": gold.geo_allocation(_gb(spark, sf))})


def latest_financials(spark, sf):
    """W4 + F1 + F3."""
    return gold.latest_financials(_fin(spark, sf))


def portfolio_table(spark, sf):
    """J2, C1, O4, D16."""
    return views.serve(spark, "portfolio", {"portfolio_table": gold.portfolio_table(
        _portco(spark, sf), _fin(spark, sf))})


def revenue_cagr(spark, sf):
    """first/last actual year and value, CAGR."""
    return cagr(_fin(spark, sf), "company_id", "year", "revenue_m",
                where="NOT is_estimate", keep_parts=True)


def company_financials(spark, sf):
    """J4, O5."""
    return views.serve(spark, "all_financials",
                       {"company_financials": gold.company_financials(_fin(spark, sf))})


def company_financials_by_id(spark, sf):
    """F4 / Q6 keyed by data: the financials of the largest holding.

    The id comes from the data (a one-row aggregate), so the lookup is a
    semi join against one row rather than a literal.
    """
    pc = _portco(spark, sf)
    # one row, used by both feeds: computed once
    top = F.broadcast(materialize(pc.where(F.col("fmv").isNotNull()).agg(
        F.max_by("id", F.struct(F.col("fmv"), -F.col("id"))).alias("company_id"))))
    # YoY and CAGR are per company: restricting the orders that feed revenue
    # and EBITDA to the one company gives the same rows; lineitem is cut to
    # those orders by a semi join whose small side has a known size.
    fin = silver.company_financials(star.revenue(spark, sf, companies=top),
                                    star.ebitda(spark, sf, companies=top))
    return gold.company_financials(fin).orderBy(F.col("year").asc_nulls_last(), "is_estimate")


def company_by_literal_id(spark, sf):
    """F4 / Q6 by a literal id through the serving statement (company 1)."""
    return views.serve(spark, "company_financials", {"company_financials": gold.company_financials(
        _fin(spark, sf))}, company_id=1)


def pipeline_by_stage(spark, sf):
    """A4: per-stage aggregates (count, equity, weighted equity, mean probability)."""
    return _pl(spark, sf).groupBy("stage").agg(*gold.stage_aggs())


def pipeline(spark, sf):
    """A4 + J5 + O6."""
    return views.serve(spark, "pipeline", {"pipeline": gold.pipeline(_pl(spark, sf))})


def leverage_bands(spark, sf):
    """C2, A5, O7."""
    return views.serve(spark, "leverage_bands",
                       {"risk_leverage_bands": gold.risk_leverage_bands(_portco(spark, sf))})


def moic_bands(spark, sf):
    """C3, A6, O7."""
    return views.serve(spark, "moic_bands",
                       {"risk_moic_bands": gold.risk_moic_bands(_portco(spark, sf))})


def leverage_stats(spark, sf):
    """A10."""
    return global_stats(_portco(spark, sf), [
        F.expr(f"{sql_round(sql_avg('net_leverage_x'), 2)} AS avg_net_leverage_x"),
        F.expr(f"{sql_round('max(net_leverage_x)', 2)} AS max_net_leverage_x")])


def weighted_returns(spark, sf):
    """A11 with both NULL-weight policies."""
    return global_stats(_portco(spark, sf), [
        weighted_mean("moic", "fmv").alias("weighted_avg_moic"),
        weighted_mean("irr", "fmv").alias("weighted_avg_irr"),
        weighted_mean("moic", "fmv", "drop").alias("weighted_avg_moic_drop"),
        weighted_mean("irr", "fmv", "drop").alias("weighted_avg_irr_drop")])


def risk_summary(spark, sf):
    """A12, F5, O8."""
    # holdings feed five branches (statistics, two passes of each HHI): their
    # eight columns are computed once, as the batch job does by writing Silver
    pc = materialize(_portco(spark, sf).select("id", "sector", "geography", "status", "fmv", "moic",
                                               "irr", "net_leverage_x"))
    sb = silver.sector_breakdown(star.sector_breakdown(pc))
    gb = silver.geo_breakdown(star.geo_breakdown(pc))
    return views.serve(spark, "risk_summary", {"risk_summary": gold.risk_summary(pc, sb, gb)})


# -- Reshaping, sources and sinks --------------------------------------------

def unpivot_years_(spark, sf):
    """Revenue feed -> {year[E]: value} map per company -> rows again."""
    rev = star.revenue(spark, sf)
    key = F.concat(F.col("year").cast("string"),
                   F.when(F.col("is_estimate"), F.lit("E")).otherwise(F.lit("")))
    nested = rev.groupBy("company_id", "company_name").agg(
        F.map_from_entries(F.collect_list(F.struct(key, F.col("revenue_m")))).alias("revenue"))
    return unpivot_years(nested, ["company_id", "company_name"], "revenue", "revenue_m")


def flatten_entities(spark, sf):
    """D18 + D13: holdings nested in camelCase structs -> flat snake_case."""
    h = star.holdings(spark, sf, AS_OF)
    nested = h.select(
        F.struct("id", "name", "sector", "subsector", "geography", "status", "description",
                 F.col("employees")).alias("company"),
        F.struct(F.col("entry_year").alias("entryYear"), F.col("entry_ev").alias("entryEV"),
                 F.col("entry_ebitda").alias("entryEBITDA"),
                 F.col("entry_multiple").alias("entryMultiple"),
                 F.col("invested_capital").alias("investedCapital"),
                 F.col("ownership_pct").alias("ownershipPct")).alias("entry"),
        F.struct(F.col("current_ev").alias("currentEV"),
                 F.col("current_ebitda").alias("currentEBITDA"),
                 F.col("current_multiple").alias("currentMultiple"), "fmv", "moic", "irr",
                 "debt", F.when(F.col("realized") != 0, F.col("realized")).alias("realized"))
        .alias("valuation"))
    return flatten(nested, defaults={"realized": 0.0})


def flatten_json_events(spark, sf):
    """D18 on JSON text: each event nested with its parsed ``props`` document,
    flattened by an explicit field mapping."""
    ev = star.table(spark, sf, "events")
    nested = ev.select(F.struct("event_id", "user_id", "event_type").alias("event"),
                       F.from_json("props", "k int").alias("props"))
    return flatten(nested, {"event.event_id": "event_id", "event.user_id": "user_id",
                            "event.event_type": "event_type", "props.k": "props_k"})


def bronze_roundtrip(spark, sf):
    """Holdings landed as Bronze CSV (load_date layout)
    in a fresh folder of the shared lake, read back as text, typed to T1."""
    root = fresh_dir(spark, "bronze")
    write_bronze(star.holdings(spark, sf, AS_OF), root, "portfolio-companies", "2002-01-01")
    raw = read_bronze(spark, root, "portfolio-companies", "2002-01-01")
    return silver.portfolio_companies(raw, AS_OF)


TEXT_DATE = "2002-01-01"


def _from_text(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """The Silver table built from its Bronze entities, landed as CSV and read back as text."""
    def query(spark, sf):
        entities, build = SILVER_SOURCES[table]
        root, typed = fresh_dir(spark, "bronze"), star.bronze_entities(spark, sf)
        for entity in entities:
            write_bronze(typed[entity], root, entity, TEXT_DATE)
        return build(*[read_bronze(spark, root, e, TEXT_DATE) for e in entities])
    query.__doc__ = f"Typed projection and derived columns of {table} from CSV text."
    return query


def layers_roundtrip(spark, sf):
    """Bronze CSV -> Silver -> Gold Parquet by the batch jobs, registered;
    per table the row count that the job reported and the rows read back from the catalog."""
    lake = fresh_dir(spark, "lake")
    write_bronze_all(star.bronze_entities(spark, sf, stored=True), f"{lake}/bronze", TEXT_DATE)
    rows = []
    for layer, counts in (
            ("silver", etl.run_silver(spark, f"{lake}/bronze", f"{lake}/silver", TEXT_DATE, AS_OF, register=True)),
            ("gold", etl.run_gold(spark, f"{lake}/silver", f"{lake}/gold", register=True))):
        rows += [spark.table(f"{layer}.{name}").agg(F.count("*").alias("read_rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
            F.lit(n).cast("long").alias("reported_rows"), "read_rows") for name, n in counts.items()]
    return functools.reduce(DataFrame.unionByName, rows)


def _copartitioned(spark, sf) -> dict[str, DataFrame]:
    """The two company tables of Silver, written in equal hash buckets of the company and read back."""
    run = LayerRun(spark, fresh_dir(spark, "buckets"))
    for name, df in (("portfolio_companies", _portco(spark, sf)), ("company_financials", _fin(spark, sf))):
        run.write(df, name, sort_within=etl.BUCKET_SORT[name], bucket_by=etl.BUCKET_KEYS[name])
    snapshot = run.commit()
    return {name: snapshot.read(spark, name) for name in snapshot.paths}


def portfolio_copartitioned(spark, sf):
    """G6 over bucketed Silver (J2, W4 without an exchange by company)."""
    sv = _copartitioned(spark, sf)
    return gold.portfolio_table(sv["portfolio_companies"], sv["company_financials"])


def financials_copartitioned(spark, sf):
    """G7 over bucketed Silver (J4, A7-A9 without an exchange by company)."""
    return gold.company_financials(_copartitioned(spark, sf)["company_financials"])


def _holdings_text(spark, sf) -> DataFrame:
    h = star.holdings(spark, sf, AS_OF)
    return h.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in h.columns])


def infer_types_(spark, sf):
    """Narrowest type per column of the holdings' Bronze text."""
    return infer_types(_holdings_text(spark, sf))


def decode_text(spark, sf):
    """holdings' Bronze text decoded per column to its narrowest type
    (one inference aggregate; its per-column result is schema-sized).  The
    text is read twice (inference, then decoding), so it is written once."""
    path = fresh_dir(spark, "text")
    _holdings_text(spark, sf).write.parquet(path)
    return decode(spark.read.parquet(path))


def cast_rejects(spark, sf):
    """Per-column validation report of the holdings' Bronze text."""
    return cast_report(_holdings_text(spark, sf), schemas.PORTFOLIO_COMPANIES)


def multiples_check_(spark, sf):
    """Supplied vs recomputed fund multiples."""
    return multiples_check(_fm(spark, sf))


def irr_by_company(spark, sf):
    """IRR per company from dated order flows (F paid in, O/P paid out)."""
    o = star.table(spark, sf, "orders")
    flows = o.select("o_custkey", "o_orderdate", F.when(
        F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(
        F.col("o_totalprice")).alias("amount"))
    return irr(flows, "o_custkey", "o_orderdate", "amount", out_key="company_id")


def seeds_to_bronze(spark, sf):
    """Holdings with year maps written as nested JSON Lines, read back with the
    entity's schema and flattened to the revenue feed."""
    def year_map(feed: DataFrame, value: str) -> DataFrame:
        year = F.concat(F.col("year").cast("string"), F.when(F.col("is_estimate"), F.lit("E")).otherwise(F.lit("")))
        return feed.where(f"{value} IS NOT NULL").groupBy("company_id").agg(
            F.map_from_entries(F.collect_list(F.struct(year, F.col(value)))).alias(value))

    h = star.holdings(spark, sf, AS_OF)
    fields = [F.col(c).alias(f) for f, c in seeds.COMPANY_FIELDS.items()]
    maps = year_map(star.revenue(spark, sf), "revenue_m").join(
        year_map(star.ebitda(spark, sf), "ebitda_m"), "company_id", "left")
    nested = h.join(maps, h["id"] == maps["company_id"]).select(
        *fields, F.col("revenue_m").alias("revenue"), F.col("ebitda_m").alias("ebitda"))
    path = fresh_dir(spark, "seeds")
    nested.write.json(path)
    companies = seeds.read_records(spark, path, seeds.COMPANY_FIELDS,
                                   (("revenue", seeds.YEAR_MAP), ("ebitda", seeds.YEAR_MAP)))
    return seeds.companies_to_bronze(companies)["company-revenue"]


# Serving views whose order is compared row by row, and the columns that name a row.
ORDERED_VIEWS = {"nav_history": ("nav_history", "quarter"), "cashflow": ("cashflow_jcurve", "quarter"),
                 "portfolio": ("portfolio_table", "id"), "sector_allocation": ("sector_allocation", "sector"),
                 "geo_allocation": ("geo_allocation", "region"), "pipeline": ("pipeline", "id"),
                 "all_financials": ("company_financials", "concat_ws(' ', company_id, year)"),
                 "leverage_bands": ("risk_leverage_bands", "leverage_band"),
                 "moic_bands": ("risk_moic_bands", "moic_band")}


def served_order(spark, sf):
    """Position of every row in the served order of the nine ordered views."""
    pc, fin = materialize(_portco(spark, sf)), materialize(_fin(spark, sf))
    tables = {
        "nav_history": gold.nav_history(silver.fund_history(star.fund_history(spark, sf))),
        "cashflow_jcurve": gold.cashflow_jcurve(silver.quarterly_cashflows(star.cashflows(spark, sf))),
        "portfolio_table": gold.portfolio_table(pc, fin), "pipeline": gold.pipeline(_pl(spark, sf)),
        "sector_allocation": gold.sector_allocation(_sb(spark, sf)), "geo_allocation": gold.geo_allocation(_gb(spark, sf)),
        "company_financials": gold.company_financials(fin), "risk_leverage_bands": gold.risk_leverage_bands(pc),
        "risk_moic_bands": gold.risk_moic_bands(pc)}
    # the id of a row in its sorted partition rises with the order; it is fixed before it is counted
    rows = [materialize(views.serve(spark, view, {name: tables[name]}).select(
        F.lit(view).alias("view"), F.expr(f"CAST({key} AS STRING)").alias("row_key"), F.monotonically_increasing_id().alias("_at")))
        for view, (name, key) in ORDERED_VIEWS.items()]
    placed = functools.reduce(DataFrame.unionByName, [number_rows(r, "_at", "position") for r in rows])
    return placed.select("view", "row_key", "position")


def irr_check_(spark, sf):
    """X2 verified: every company that must have a rate has one at which its value changes sign."""
    o = star.table(spark, sf, "orders")
    flows = o.select("o_custkey", "o_orderdate", F.when(
        F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(
        F.col("o_totalprice")).alias("amount"))
    return irr_check(flows, "o_custkey", "o_orderdate", "amount", out_key="company_id")


def cast_rejects_corrupted(spark, sf):
    """X3 on text with unreadable cells: the report of the holdings with every tenth value spoilt."""
    h = _holdings_text(spark, sf)
    spoilt = {"employees": "'n/a'", "fmv": "concat(fmv, 'x')", "entry_year": "'12.x'", "id": "id"}
    text = h.selectExpr(*[f"CASE WHEN CAST(id AS BIGINT) % 10 = 3 THEN {spoilt[c]} ELSE {c} END AS {c}"
                          if c in spoilt else c for c in h.columns])
    return cast_report(text, schemas.PORTFOLIO_COMPANIES)


# -- Many drops: layouts, ledger, increments ----------------------------------

DROP_DATES = ("2002-01-01", "2002-02-01")


def _two_drops(spark, sf) -> str:
    """The deals landed on two dates: as they are, and in another column order, without ``notes``
    and with a column of its own, ``desk``, ids as codes; returns the entity's folder."""
    root, deals_ = fresh_dir(spark, "bronze"), star.deals(spark, sf)
    write_bronze(deals_, root, "deal-pipeline", DROP_DATES[0])
    other = deals_.selectExpr("owner AS desk", *[f"concat(CAST(id AS STRING), 'D') AS {c}" if c == "id" else c
                                                 for c in reversed(deals_.columns) if c != "notes"])
    return write_bronze(other, root, "deal-pipeline", DROP_DATES[1])


def registered_two_headers(spark, sf):
    """Drops with different headers behind one registered name; every column by its name."""
    path = _two_drops(spark, sf)
    create_layers(spark, path.rsplit("/", 1)[0], ["bronze"])
    name = "deals_" + path.split("/")[-2].rsplit("-", 1)[-1]
    return register_table(spark, "bronze", name, path, "csv").selectExpr(
        "load_date", "id", "stage", "CAST(equity_m AS DOUBLE) AS equity_m", "owner", "notes", "desk")


def schema_drift(spark, sf):
    """Columns added, removed and retyped between the two drops."""
    path = _two_drops(spark, sf)
    return drift(types_by_date(read_dates(spark, path), layouts(spark, [path])))


def decode_codes(spark, sf):
    """Order keys as codes that only the JVM's parser takes for numbers stay text; prices become doubles."""
    text = star.table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id", "concat(CAST(o_orderkey AS STRING), IF(o_orderkey % 2 = 0, 'D', 'f')) AS code",
        "concat('0x', CAST(o_orderkey AS STRING)) AS hex", "CAST(o_totalprice AS STRING) AS price")
    path = fresh_dir(spark, "text")
    text.write.parquet(path)
    return decode(spark.read.parquet(path))


def quoted_text(spark, sf):
    """Quotes, separators and line breaks in landed text come back as they were."""
    root = fresh_dir(spark, "bronze")
    text = star.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "concat('\"', o_orderpriority, '\", ', o_orderstatus, '\\n', CAST(o_custkey AS STRING)) AS name")
    write_bronze(text, root, "deal-pipeline", TEXT_DATE)
    return read_bronze(spark, root, "deal-pipeline", TEXT_DATE).selectExpr("CAST(id AS BIGINT) AS id", "name")


def backfill_cashflows(spark, sf):
    """Events landed as one drop per day, all days built by one backfill; running totals start anew each day."""
    lake = fresh_dir(spark, "lake")
    ev = star.table(spark, sf, "events").selectExpr(
        "event_id AS row_num", "event_type AS quarter", "value AS contributions_m", "-value AS distributions_m",
        "value / 2 AS net_cashflow_m", "CAST(CAST(ts AS DATE) AS STRING) AS load_date")
    write_drops(ev, f"{lake}/bronze", "cashflows")
    backfill(spark, f"{lake}/bronze", f"{lake}/silver", ["quarterly_cashflows"])
    return spark.read.parquet(f"{lake}/silver/quarterly_cashflows").selectExpr(
        "CAST(load_date AS STRING) AS load_date", "row_num", "cum_contributions_m", "cum_distributions_m", "cum_net_cashflow_m")


def running_total_increments(spark, sf):
    """The events taken in by two increments, a day of late ones in the second; equal to one full run."""
    ev = star.flows_fine(spark, sf)
    second = "CAST(ts AS DATE) >= DATE'2024-01-20' OR CAST(ts AS DATE) = DATE'2024-01-05'"
    store = RunningTotals(fresh_dir(spark, "totals"), ["ts", "event_id"], ["value"])
    store.append(ev.where(f"NOT ({second})"))
    store.append(ev.where(second))
    return store.read(spark).select("event_id", "value", F.col("cum_value"))


def company_unknown_id(spark, sf):
    """F4 / Q6 for an id that no company has: no rows, the served columns."""
    return views.serve(spark, "company_financials", {"company_financials": gold.company_financials(
        _fin(spark, sf))}, company_id=10 ** 15)


def company_by_name(spark, sf):
    """F4 by a column that does not order the table: Bloom filters of G7's names skip row groups."""
    run = LayerRun(spark, fresh_dir(spark, "bloom"))
    name = "company_financials"
    run.write(gold.company_financials(_fin(spark, sf)), name, cluster_by=etl.CLUSTER_KEYS[name], bloom_by=etl.BLOOM_KEYS[name])
    return run.commit().read(spark, name).where("company_name = 'Customer#000000007'")


def served_page(spark, sf):
    """The third page of 50 rows of the portfolio view, reached by the tokens of the first two."""
    path = fresh_dir(spark, "page")
    gold.portfolio_table(_portco(spark, sf), _fin(spark, sf)).write.parquet(path)
    table, keys, token = spark.read.parquet(path), pages.VIEW_KEYS["portfolio"], None
    for _ in range(2):
        token = pages.page(table, keys, 50, token).token
    rows = pages.page(table, keys, 50, token).rows
    return spark.createDataFrame([(101 + i, r["id"], r["fmv"]) for i, r in enumerate(rows)], "position long, id long, fmv double")


def multiples_check_perturbed(spark, sf):
    """X1 on supplied multiples that are off by known amounts, or missing."""
    fm = _fm(spark, sf).withColumns({"tvpi": F.expr("tvpi + 0.25"), "dpi": F.expr("dpi - 0.5"), "rvpi": F.expr("CAST(NULL AS DOUBLE)")})
    return multiples_check(fm)


# -- Stored states, validation, all roots, unknown fields ---------------------

def _portfolio_states(spark, sf) -> partials.PartialStats:
    """States of the holdings by entry year, from two deliveries; the first held wrong values of 1993."""
    pc = materialize(_portco(spark, sf).select("entry_year", "sector", "geography", "status", "fmv", "invested_capital", "moic", "irr", "net_leverage_x"))
    states = partials.portfolio_states(fresh_dir(spark, "states"), ["entry_year"])
    states.update(pc.where("coalesce(entry_year <= 1993, true)").withColumn("fmv", F.expr("IF(entry_year = 1993, fmv * 2, fmv)")))
    states.update(pc.where("entry_year >= 1993"))
    return states


def kpis_from_states(spark, sf):
    """G1: A1, A2, F2 merged from stored states."""
    return partials.fund_kpis(spark, _portfolio_states(spark, sf), _fm(spark, sf))


def risk_from_states(spark, sf):
    """A3, A10-A12 merged from stored states."""
    return partials.risk_summary(spark, _portfolio_states(spark, sf))


def _validated_feed(spark, sf) -> Validation:
    """The revenue feed with years, signs, names and companies spoilt by the company's last digit, and some rows twice."""
    feed = star.revenue(spark, sf)
    spoilt = feed.selectExpr(
        "IF(company_id % 10 = 5, company_id + 1000000000000, company_id) AS company_id", "IF(company_id % 10 = 7, NULL, company_name) AS company_name",
        "IF(company_id % 10 = 3, year + 1000, year) AS year", "is_estimate", "IF(company_id % 10 = 4, -revenue_m, revenue_m) AS revenue_m")
    return validate(spoilt.unionByName(spoilt.where("company_id % 10 = 6")), [
        in_range("year", 1900, 2100), in_range("revenue_m", 0.0), present("company_name"), unique(["company_id", "year", "is_estimate"], "one_row"),
        refers(["company_id"], star.table(spark, sf, "customer"), ["c_custkey"]), row_change(feed.count(), 0.95, 1.05)])


def validated_feed(spark, sf):
    """The report of the rules over the spoilt revenue feed."""
    return _validated_feed(spark, sf).report


def quarantined_feed(spark, sf):
    """The rows of the spoilt revenue feed that break a rule, whole, with the rules."""
    return _validated_feed(spark, sf).quarantined.select("company_id", "company_name", "year", "is_estimate", "revenue_m",
                                                         F.array_join(FAILED, ",").alias("failed"))


def irr_roots_constructed(spark, sf):
    """Yearly flows of every customer made to have one, two or three known rates; all are found."""
    a, b, c = "(1.01D + c_custkey % 20 / 100D)", "(1.26D + c_custkey % 20 / 100D)", "(1.61D + c_custkey % 20 / 100D)"
    one = [f"{a}"]
    two = [f"{a} + {b}", f"-{a} * {b}"]
    three = [f"{a} + {b} + {c}", f"-({a} * {b} + {b} * {c} + {c} * {a})", f"{a} * {b} * {c}"]
    amounts = " ".join(f"WHEN {n} THEN array({', '.join(f'1000D * ({x})' for x in ['-1D', *flows])})" for n, flows in ((1, one), (2, two), (0, three)))
    flows = star.table(spark, sf, "customer").select("c_custkey", F.posexplode(F.expr(f"CASE c_custkey % 3 {amounts} END")).alias("at", "amount"))
    found = irr_roots(flows, "c_custkey", F.expr("date_add(DATE'2001-01-01', 365 * at)"), "amount", out_key="company_id", scale=4)
    return found.select("company_id", "sign_changes", "n_roots", "unresolved", "irr_pct", F.posexplode("roots_pct").alias("root_no", "root_pct"))


def irr_root_parity(spark, sf):
    """X2 on order flows: the roots are at most the sign changes of the net flows, and as many but for an even number."""
    o = star.table(spark, sf, "orders")
    flows = o.selectExpr("o_custkey", "o_orderdate", "IF(o_orderstatus = 'F', -o_totalprice, o_totalprice) AS amount")
    return irr_roots(flows, "o_custkey", "o_orderdate", "amount", out_key="company_id").selectExpr(
        "company_id", "sign_changes", "n_roots <= sign_changes AS bounded", "(sign_changes - n_roots) % 2 = 0 AS parity",
        "(irr_pct IS NOT NULL) = (n_roots > 0) AS has_rate")


def _seeds_with_extra(spark, sf) -> str:
    """Holdings as JSON Lines with fields that no table names; some have an object, some values of two kinds."""
    h = star.holdings(spark, sf, AS_OF)
    record = [*[f"{c} AS {f}" for f, c in seeds.COMPANY_FIELDS.items()], "IF(id % 3 = 0, id % 100, NULL) AS esgScore",
              "IF(id % 4 = 1, named_struct('chair', name, 'n', id % 9), NULL) AS board", "id / 4D + 0.125D AS driftRate"]
    names = ", ".join(e.rsplit(" AS ", 1)[1] for e in record)
    path = fresh_dir(spark, "seeds")
    (h.selectExpr(*record, "id AS _id")
      .selectExpr(f"IF(_id % 2 = 0, to_json(struct({names}, _id AS dealRef)), to_json(struct({names}, concat('R', _id) AS dealRef))) AS value")
      .write.text(path))
    return path


def seeds_extra_keys(spark, sf):
    """Records with unknown fields, landed as Bronze CSV and read back with a column for each."""
    records, extra = seeds.read_with_extra(spark, _seeds_with_extra(spark, sf), seeds.COMPANY_FIELDS)
    root = fresh_dir(spark, "bronze")
    write_bronze(seeds.companies_to_bronze(records.withColumns({c: F.lit(None).cast(seeds.YEAR_MAP) for c in ("revenue", "ebitda")}), extra)[
        "portfolio-companies"], root, "portfolio-companies", TEXT_DATE)
    return read_bronze(spark, root, "portfolio-companies", TEXT_DATE).selectExpr(
        "CAST(id AS BIGINT) AS id", "status", "CAST(esg_score AS BIGINT) AS esg_score", "board", "deal_ref", "CAST(drift_rate AS DOUBLE) AS drift_rate")


def seeds_extra_fields(spark, sf):
    """The unknown fields, with the type that holds all their values."""
    return variants.extra_fields(variants.read_lines(spark, _seeds_with_extra(spark, sf)), list(seeds.COMPANY_FIELDS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "leverage_bands": leverage_bands,
    "moic_bands": moic_bands,
    "holding_metrics": holding_metrics,
    "financial_margins": financial_margins,
    "yoy_growth": yoy_growth,
    "running_cashflows": running_cashflows,
    "running_total_distributed": running_total_distributed,
    "number_rows": number_rows_,
    "nav_history": nav_history,
    "fund_ratios": fund_ratios,
    "fund_kpis": fund_kpis,
    "sector_allocation": sector_allocation,
    "geo_allocation": geo_allocation,
    "latest_financials": latest_financials,
    "portfolio_table": portfolio_table,
    "revenue_cagr": revenue_cagr,
    "company_financials": company_financials,
    "company_financials_by_id": company_financials_by_id,
    "weighted_pipeline": weighted_pipeline,
    "pipeline_by_stage": pipeline_by_stage,
    "deal_pipeline": pipeline,
    "leverage_stats": leverage_stats,
    "weighted_returns": weighted_returns,
    "risk_summary": risk_summary,
    "unpivot_years": unpivot_years_,
    "flatten_entities": flatten_entities,
    "flatten_json_events": flatten_json_events,
    "bronze_roundtrip": bronze_roundtrip,
    "infer_types": infer_types_,
    "decode_text": decode_text,
    "cast_rejects": cast_rejects,
    "multiples_check": multiples_check_,
    "irr_by_company": irr_by_company,
    "irr_check": irr_check_,
    "company_by_literal_id": company_by_literal_id,
    "cast_rejects_corrupted": cast_rejects_corrupted,
    "layers_roundtrip": layers_roundtrip,
    "portfolio_copartitioned": portfolio_copartitioned,
    "financials_copartitioned": financials_copartitioned,
    "seeds_to_bronze": seeds_to_bronze,
    "served_order": served_order,
    "registered_two_headers": registered_two_headers,
    "schema_drift": schema_drift,
    "decode_codes": decode_codes,
    "quoted_text": quoted_text,
    "backfill_cashflows": backfill_cashflows,
    "running_total_increments": running_total_increments,
    "company_unknown_id": company_unknown_id,
    "served_page": served_page,
    "company_by_name": company_by_name,
    "multiples_check_perturbed": multiples_check_perturbed,
    "kpis_from_states": kpis_from_states,
    "risk_from_states": risk_from_states,
    "validated_feed": validated_feed,
    "quarantined_feed": quarantined_feed,
    "irr_roots_constructed": irr_roots_constructed,
    "irr_root_parity": irr_root_parity,
    "seeds_extra_keys": seeds_extra_keys,
    "seeds_extra_fields": seeds_extra_fields,
    **{f"text_{t}": _from_text(t) for t in SILVER_SOURCES if t != "portfolio_companies"},
}

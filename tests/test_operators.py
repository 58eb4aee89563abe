"""Hand-made rows for every trap listed in FIXTURES.md section 4."""

import math

import pandas as pd
from pyspark.sql import functions as F

from fundlake.operators import (cagr, cast_rejects, concentration, flatten, growth, latest_per_key,
                                number_rows, running_total, to_snake, unpivot_years,
                                weighted_mean)
from fundlake.operators.bands import LEVERAGE_LABELS, MOIC_LABELS
from fundlake.plans import gold, silver
from fundlake.schemas import PORTFOLIO_COMPANIES, text_schema


def _portco_text(spark, rows):
    """Bronze text rows for portfolio companies (dict per row, missing -> NULL)."""
    cols = [f.name for f in PORTFOLIO_COMPANIES.fields]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, text_schema(PORTFOLIO_COMPANIES))


def test_leverage_and_moic_bands_edges_and_nulls(spark):
    rows = [dict(id=str(i), status="Active", fmv="10", debt=str(d), current_ebitda=str(e),
                 moic=m, irr="5") for i, (d, e, m) in enumerate([
                     (3.0, 1, "1.0"), (5.0, 1, "1.5"), (6.0, 1, "2.0"), (7.0, 1, "3.0"),
                     (1.0, 0, None), (1.0, None, "0.5")])]
    pc = silver.portfolio_companies(_portco_text(spark, rows))
    flagged = {r["id"]: r["risk_flag"] for r in
               gold.portfolio_table(pc, spark.createDataFrame(
                   [], "company_id long, year int, company_name string, is_estimate boolean, "
                       "revenue_m double, ebitda_m double, ebitda_margin_pct double, "
                       "revenue_yoy_pct double, ebitda_yoy_pct double")).collect()}
    assert flagged == {0: "OK", 1: "OK", 2: "OK", 3: "HIGH_LEVERAGE", 4: "OK", 5: "BELOW_COST"}
    lev = {r["leverage_band"]: r["company_count"] for r in gold.risk_leverage_bands(pc).collect()}
    assert lev == {LEVERAGE_LABELS[0]: 1, LEVERAGE_LABELS[1]: 1, LEVERAGE_LABELS[2]: 2,
                   LEVERAGE_LABELS[3]: 2}
    moic = {r["moic_band"]: r["company_count"] for r in gold.risk_moic_bands(pc).collect()}
    assert moic == {MOIC_LABELS[0]: 1, MOIC_LABELS[1]: 1, MOIC_LABELS[2]: 1, MOIC_LABELS[3]: 1,
                    MOIC_LABELS[4]: 2}


def test_risk_flag_order_and_high_leverage(spark):
    rows = [dict(id="1", status="Watch", debt="100", current_ebitda="1", moic="0.5"),
            dict(id="2", status="Active", debt="6.01", current_ebitda="1", moic="0.5"),
            dict(id="3", status="Exited", debt="1", current_ebitda="1", moic="0.99")]
    pc = silver.portfolio_companies(_portco_text(spark, rows))
    empty = spark.createDataFrame([], "company_id long, year int, company_name string, "
                                      "is_estimate boolean, revenue_m double, ebitda_m double, "
                                      "ebitda_margin_pct double, revenue_yoy_pct double, "
                                      "ebitda_yoy_pct double")
    got = {r["id"]: r["risk_flag"] for r in gold.portfolio_table(pc, empty).collect()}
    assert got == {1: "WATCH", 2: "HIGH_LEVERAGE", 3: "BELOW_COST"}


def test_status_outside_active_watch_counted_by_neither(spark):
    rows = [dict(id="1", status="Active", fmv="1"), dict(id="2", status="Watch", fmv="1"),
            dict(id="3", status="Exited", fmv="1"), dict(id="4", status=None, fmv="1")]
    pc = silver.portfolio_companies(_portco_text(spark, rows))
    fm = spark.createDataFrame([("F",)], "fund_name string")
    r = gold.fund_kpis(fm, pc).first()
    assert (r["active_companies"], r["watch_companies"], r["total_fmv_m"]) == (1, 1, 4.0)


def _feeds(spark, rev, eb):
    r = spark.createDataFrame(rev, "company_id string, company_name string, year string, "
                                   "is_estimate string, revenue_m string")
    e = spark.createDataFrame(eb, "company_id string, company_name string, year string, "
                                  "is_estimate string, ebitda_m string")
    return r, e


def test_actual_and_estimate_same_year_do_not_fan_out(spark):
    r, e = _feeds(spark, [("1", "A", "2026", "0", "100"), ("1", "A", "2026", "1", "120")],
                  [("1", "A", "2026", "0", "10"), ("1", "A", "2026", "1", "30")])
    fin = silver.company_financials(r, e).orderBy("is_estimate").collect()
    assert [(x["is_estimate"], x["ebitda_m"]) for x in fin] == [(False, 10.0), (True, 30.0)]
    assert fin[0]["ebitda_margin_pct"] == 10.0 and fin[1]["ebitda_margin_pct"] == 25.0
    assert fin[1]["revenue_yoy_pct"] == 20.0  # estimate follows the actual row
    year_only = silver.company_financials(r, e, keys=("company_id", "year"))
    assert year_only.count() == 4  # the reference's year-only key fans out 2x2


def test_yoy_previous_row_gap_zero_and_first(spark):
    r, e = _feeds(spark, [("1", "A", "2020", "0", "0"), ("1", "A", "2021", "0", "50"),
                          ("1", "A", "2024", "0", "75"), ("1", "A", "2025", "0", "-75")],
                  [])
    fin = {x["year"]: x["revenue_yoy_pct"] for x in silver.company_financials(r, e).collect()}
    assert fin == {2020: None, 2021: None, 2024: 50.0, 2025: -200.0}


def test_cagr_cases(spark):
    rows = [(1, 2020, 100.0), (2, 2020, -5.0), (2, 2022, 10.0), (3, 2020, 100.0),
            (3, 2022, -50.0), (4, 2019, None), (4, 2020, 100.0), (4, 2022, 121.0),
            (5, 2020, 100.0), (5, 2022, 121.0)]
    df = spark.createDataFrame(rows, "company_id long, year int, revenue_m double")
    got = {r["company_id"]: r for r in cagr(df, "company_id", "year", "revenue_m",
                                            keep_parts=True).collect()}
    assert got[1]["revenue_cagr_pct"] is None                  # one year
    assert got[2]["revenue_cagr_pct"] is None                  # first <= 0
    assert math.isnan(got[3]["revenue_cagr_pct"])              # negative last -> NaN
    assert got[4]["first_year"] == 2019                        # span starts at the NULL year
    assert got[4]["revenue_cagr_pct"] == round((1.21 ** (1 / 3) - 1) * 100, 2)
    assert got[5]["revenue_cagr_pct"] == 10.0


def test_latest_per_key_tie_is_deterministic(spark):
    rows = [(1, 2024, False, 5.0), (1, 2024, False, 7.0), (1, 2023, False, 9.0),
            (2, 2025, True, 1.0), (2, 2022, False, 2.0)]
    df = spark.createDataFrame(rows, "company_id long, year int, is_estimate boolean, v double")
    outs = set()
    for n in (1, 3, 5):
        res = latest_per_key(df.repartition(n), "company_id", "year", cols=["year", "v"],
                             where=~F.col("is_estimate")).orderBy("company_id").collect()
        outs.add(tuple(tuple(r) for r in res))
    assert outs == {((1, 2024, 7.0), (2, 2022, 2.0))}


def test_weighted_mean_null_value_keeps_weight(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, None)], "fmv double, moic double")
    r = df.agg(weighted_mean("moic", "fmv").alias("keep"),
               weighted_mean("moic", "fmv", "drop").alias("drop")).first()
    assert (r["keep"], r["drop"]) == (1.0, 2.0)


def test_weights_hhi_and_zero_total(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 30.0), ("c", 20.0)], "s string, fmv_m double")
    res = {r["s"]: r for r in concentration(df, "fmv_m", "hhi").collect()}
    assert res["a"]["weight_pct"] == 50.0 and res["b"]["hhi_contribution"] == 900.0
    assert res["a"]["hhi"] == 3800.0
    z = spark.createDataFrame([("a", 0.0)], "s string, fmv_m double")
    assert concentration(z, "fmv_m", "hhi").first()["weight_pct"] is None


def test_fund_ratios_zero_divisor(spark):
    raw = spark.createDataFrame([("0", "5", "1", "0")], "committed_capital string, "
                                "called_capital string, nav string, total_value string")
    fm = silver.fund_metrics(raw.select("*", *[F.lit(None).cast("string").alias(c) for c in (
        "fund_name short_name vintage strategy geography uncalled_capital distributions tvpi "
        "dpi rvpi net_irr gross_irr moic management_fee_pct carry_pct hurdle_rate_pct "
        "num_portcos as_of_date").split()])).first()
    assert fm["deployed_pct"] is None and fm["unrealised_pct"] is None


def test_pipeline_null_stage_gets_null_aggregates(spark):
    raw = spark.createDataFrame([("1", "A", "10", "50"), ("2", "A", "30", "100"),
                                 ("3", None, "5", "10")],
                                "id string, stage string, equity_m string, probability string")
    cols = "name sector subsector source target_ev_m ev_ebitda owner description notes".split()
    pl = silver.deal_pipeline(raw.select("*", *[F.lit(None).cast("string").alias(c) for c in cols]))
    got = {r["id"]: r for r in gold.pipeline(pl).collect()}
    assert got[1]["stage_count"] == 2 and got[1]["stage_weighted_m"] == 35.0
    assert got[1]["stage_avg_prob"] == 75.0 and got[3]["stage_count"] is None


def test_empty_input_risk_summary_is_one_typed_row(spark):
    pc = silver.portfolio_companies(_portco_text(spark, []))
    sb = spark.createDataFrame([], "sector string, fmv_m double")
    gb = spark.createDataFrame([], "region string, fmv_m double")
    rows = gold.risk_summary(pc, sb, gb).collect()
    assert len(rows) == 1 and rows[0]["active_count"] == 0 and rows[0]["hhi_sector"] is None


def _brute_cum(pdf, order, col):
    pdf = pdf.sort_values(order, na_position="first", kind="mergesort")
    acc, out, seen = 0, [], False
    for v in pdf[col]:
        if not pd.isna(v):
            acc += round(v * 100)
            seen = True
        out.append(round(acc / 100, 2) if seen else None)
    return dict(zip(pdf["id"], out))


def test_running_total_matches_brute_force_with_hot_key_and_nulls(spark):
    rows = [(i, (0 if i % 3 == 0 else i), (None if i % 11 == 0 else (i % 7) - 2.5))
            for i in range(1, 400)] + [(1000, None, 4.0), (1001, None, None)]
    df = spark.createDataFrame(rows, "id long, k long, v double")
    got = {r["id"]: r["cum_v"] for r in running_total(df, "k", ["v"], tiebreak=["id"],
                                                      partitions=6).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "k", "v"])
    assert got == _brute_cum(pdf, ["k", "id"], "v")


def test_number_rows_dense_positions(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(100)], "id long, k long")
    res = number_rows(df, "k", tiebreak=["id"], partitions=4).collect()
    exp = {i: n for n, i in enumerate(sorted(range(100), key=lambda i: (i % 5, i)), start=1)}
    assert {r["id"]: r["row_num"] for r in res} == exp


def test_growth_custom_output(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 15.0)], "k long, t int, x double")
    got = [r["g"] for r in growth(df, "k", "t", ["x"], out=["g"]).orderBy("t").collect()]
    assert got == [None, 50.0]


def test_unpivot_years_estimate_suffix(spark):
    df = spark.createDataFrame([(1, {"2025": 1.0, "2026": 2.0, "2026E": 3.0})],
                               "id long, m map<string,double>")
    got = sorted(tuple(r) for r in unpivot_years(df, ["id"], "m", "v").collect())
    assert got == [(1, 2025, False, 1.0), (1, 2026, False, 2.0), (1, 2026, True, 3.0)]


def test_flatten_and_snake_case(spark):
    assert to_snake("entryEBITDA") == "entry_ebitda" and to_snake("investedCapital") == \
        "invested_capital" and to_snake("currentEV") == "current_ev"
    df = spark.createDataFrame([((1, None), (2.0,))],
                               "a struct<entryEV:long,realized:double>, b struct<fmvNow:double>")
    r = flatten(df, defaults={"realized": 0.0}).first().asDict()
    assert r == {"entry_ev": 1, "realized": 0.0, "fmv_now": 2.0}


def test_cast_rejects_quarantine(spark):
    df = spark.createDataFrame([("1", "x1", "2.5"), ("2", "", "abc"), ("zz", "n", None)],
                               "id string, name string, fmv string")
    from fundlake.schemas import _schema, L, S, D
    got = sorted(tuple(r) for r in cast_rejects(df, _schema(("id", L), ("name", S), ("fmv", D)),
                                                keys=["name"]).collect())
    assert got == [("", "fmv", "abc"), ("n", "id", "zz")]


def test_with_cagr_equals_grouped_cagr_joined_back(spark):
    from fundlake.operators import with_cagr
    rows = [(1, 2020, False, 100.0), (2, 2020, False, -5.0), (2, 2022, False, 10.0),
            (3, 2020, False, 100.0), (3, 2022, False, -50.0), (4, 2019, False, None),
            (4, 2020, False, 100.0), (4, 2022, False, 121.0), (4, 2023, True, 500.0),
            (5, 2024, True, 1.0), (6, 2020, None, 10.0)]
    df = spark.createDataFrame(rows, "company_id long, year int, is_estimate boolean, "
                                     "revenue_m double")
    win = with_cagr(df, "company_id", "year", "revenue_m", where="NOT is_estimate")
    grp = df.join(cagr(df, "company_id", "year", "revenue_m", where="NOT is_estimate"),
                  "company_id", "left")

    def norm(d):
        return sorted((r["company_id"], r["year"], "nan" if r["revenue_cagr_pct"] is not None
                       and math.isnan(r["revenue_cagr_pct"]) else r["revenue_cagr_pct"])
                      for r in d.collect())
    assert norm(win) == norm(grp)


def test_irr_known_rates(spark):
    import datetime as dt

    from fundlake.operators import irr
    d0 = dt.date(2020, 1, 1)
    rows = [(1, d0, -100.0), (1, d0 + dt.timedelta(days=365), 110.0),          # 10 %
            (2, d0, -100.0), (2, d0 + dt.timedelta(days=730), 200.0),          # sqrt(2) - 1
            (3, d0, 50.0), (3, d0 + dt.timedelta(days=365), 60.0),             # one sign
            (4, d0, -60.0), (4, d0, -40.0), (4, d0 + dt.timedelta(days=365), 110.0)]  # netted
    df = spark.createDataFrame(rows, "k long, d date, a double")
    got = {r["k"]: r for r in irr(df, "k", "d", "a").collect()}
    assert got[1]["irr_pct"] == 10.0 and got[4]["irr_pct"] == 10.0
    assert got[4]["n_flows"] == 2
    assert got[2]["irr_pct"] == round((2 ** 0.5 - 1) * 100, 2)
    assert got[3]["irr_pct"] is None


def test_nav_history_orders_quarter_labels_chronologically(spark):
    from fundlake.plans import views
    fh = spark.createDataFrame([("2001Q1", 1.0), ("Q4 2000", 2.0), ("2000Q3", 3.0), ("odd", 4.0)],
                               "quarter string, nav_m double")
    got = [r["quarter"] for r in views.serve(spark, "nav_history", {"nav_history": fh}).collect()]
    assert got == ["2000Q3", "Q4 2000", "2001Q1", "odd"]

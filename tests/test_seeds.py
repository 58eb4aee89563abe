"""Nested records -> Bronze entities -> Silver, on a hand-made fixture."""

import json
import os

from pyspark.sql import types as T

from fundlake.plans import seeds, silver
from fundlake.session import fresh_dir, local_path
from fundlake.sources import read_bronze_all, variants, write_bronze_all

FIXTURE = {
    "fund": [{"name": "Fund, One", "shortName": "F1", "vintage": 2020, "strategy": "Buyout",
              "geography": "EU", "committedCapital": 500.0, "calledCapital": 300.0,
              "uncalledCapital": 200.0, "distributions": 120.0, "nav": 330.0,
              "totalValue": 450.0, "tvpi": 1.5, "dpi": 0.4, "rvpi": 1.1, "irr": 14.2,
              "grossIrr": 19.0, "moic": 1.6, "managementFee": 2.0, "carry": 20.0,
              "hurdleRate": 8.0, "numPortcos": 2, "asOf": "2026-06-30"}],
    "companies": [
        {"id": 1, "name": "Alpha \"A\"", "sector": "Tech", "subsector": "SaaS",
         "geography": "DE", "entryYear": 2021, "entryEV": 100.0, "entryEBITDA": 10.0,
         "entryMultiple": 10.0, "invested": 60.0, "ownership": 60.0, "currentEV": 150.0,
         "currentEBITDA": 12.0, "currentMultiple": 12.5, "fmv": 90.0, "moic": 1.5, "irr": 18.0,
         "status": "Active", "debt": 30.0, "employees": 250, "description": "line1\nline2",
         "revenue": {"2024": 50.0, "2025": 60.0, "2026E": 70.0},
         "ebitda": {"2024": 10.0, "2025": 12.0, "2026E": 15.0}},
        {"id": 2, "name": "Beta", "sector": "Health", "subsector": "Care", "geography": "FR",
         "entryYear": 2022, "invested": 40.0, "fmv": 30.0, "moic": 0.8, "status": "Watch",
         "currentEBITDA": 0.0, "debt": 5.0, "realized": 2.5,
         "revenue": {"2025": 20.0, "2026": 21.0, "2026E": 22.0}, "ebitda": {"2025": 1.0}}],
    "cashflows": [{"q": "Q2 2021", "contributions": -20.0, "distributions": 0.0},
                  {"q": "2021Q1", "contributions": -50.0, "distributions": 0.0},
                  {"q": "2022Q1", "contributions": -5.0, "distributions": 30.0}],
    "history": [{"q": "2021Q1", "nav": 50.0, "irr": -3.0, "tvpi": 0.97}],
    "pipeline": [{"name": "Zeta", "stage": "DD", "equity": 10.0, "probability": 40.0},
                 {"name": "Eta", "stage": "DD", "equity": 20.0, "probability": 60.0},
                 {"name": "Theta", "stage": "LOI", "equity": 5.0, "probability": 80.0}],
    "sectors": [{"sector": "Tech", "fmv": 90.0, "count": 1, "pct": 75.0},
                {"sector": "Health", "fmv": 30.0, "count": 1, "pct": 25.0}],
    "geo": [{"region": "DE", "fmv": 90.0, "count": 1}, {"region": "FR", "fmv": 30.0, "count": 1}],
}


def test_records_to_bronze_to_silver(spark):
    root = local_path(fresh_dir(spark, "t-seeds"))
    paths = {}
    for name, rows in FIXTURE.items():
        os.makedirs(f"{root}/{name}", exist_ok=True)
        with open(f"{root}/{name}/part-0.json", "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows))
        paths[name] = f"{root}/{name}"
    entities = seeds.records_to_bronze(spark, paths)
    assert set(entities) == {"fund-metrics", "portfolio-companies", "company-revenue",
                             "company-ebitda", "cashflows", "fund-history", "deal-pipeline",
                             "sector-breakdown", "geo-breakdown"}
    write_bronze_all(entities, f"{root}/bronze", "2026-06-30")
    sv = silver.build_silver(read_bronze_all(spark, f"{root}/bronze", "2026-06-30"))
    pc = {r["id"]: r for r in sv["portfolio_companies"].collect()}
    assert pc[1]["name"] == 'Alpha "A"' and pc[1]["description"] == "line1\nline2"
    assert pc[1]["realized"] == 0.0 and pc[2]["realized"] == 2.5        # D13
    assert pc[2]["net_leverage_x"] is None and pc[1]["net_leverage_x"] == 2.5
    fin = sorted((r["company_id"], r["year"], r["is_estimate"], r["ebitda_m"])
                 for r in sv["company_financials"].collect())
    assert (1, 2026, True, 15.0) in fin and (2, 2026, False, None) in fin \
        and (2, 2026, True, None) in fin and len(fin) == 6                 # D17, no fan-out
    cf = [(r["row_num"], r["quarter"], r["cum_net_cashflow_m"]) for r in
          sv["quarterly_cashflows"].orderBy("row_num").collect()]
    assert cf == [(1, "2021Q1", -50.0), (2, "Q2 2021", -70.0), (3, "2022Q1", -45.0)]  # D14
    deals = {r["name"]: r["id"] for r in sv["deal_pipeline"].collect()}
    assert deals == {"Eta": 1, "Zeta": 2, "Theta": 3}
    fm = sv["fund_metrics"].first()
    assert fm["fund_name"] == "Fund, One" and fm["deployed_pct"] == 60.0


def _lines(spark, name, lines):
    root = local_path(fresh_dir(spark, name))
    os.makedirs(root)
    with open(f"{root}/part-0.json", "w") as fh:
        fh.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return root


def test_extra_fields_reach_bronze(spark):
    paths = {name: _lines(spark, f"t-extra-{name}", rows) for name, rows in FIXTURE.items()}
    companies = [dict(FIXTURE["companies"][0], esgScore=7, board={"chair": "X", "n": 3}, fmvM=1.5, mixed="a", realizedGain=None),
                 dict(FIXTURE["companies"][1], board={"n": 4, "seat": [1, 2]}, fmvM=2, mixed=5, entry_year="clash", listed=True)]
    paths["companies"] = _lines(spark, "t-extra", companies)
    paths["pipeline"] = _lines(spark, "t-extra-deals", [dict(r, **{"a.b": i}) for i, r in enumerate(FIXTURE["pipeline"])])
    entities = seeds.records_to_bronze(spark, paths, keep_extra=True)
    root = fresh_dir(spark, "t-extra-lake")
    write_bronze_all(entities, f"{root}/bronze", "2026-06-30")
    bronze = read_bronze_all(spark, f"{root}/bronze", "2026-06-30")
    got = {r["id"]: (r["esg_score"], r["board"], r["fmv_m"], r["mixed"], r["entry_year"], r["entry_year_extra"], r["listed"])
           for r in bronze["portfolio-companies"].collect()}
    assert got == {"1": ("7", '{"chair":"X","n":3}', "1.5", '"a"', "2021", None, None),
                   "2": (None, '{"n":4,"seat":[1,2]}', "2.0", "5", "2022", "clash", "true")}
    assert "realized_gain" not in bronze["portfolio-companies"].columns
    assert sorted(r["a_b"] for r in bronze["deal-pipeline"].collect()) == ["0", "1", "2"]
    plain = seeds.records_to_bronze(spark, paths)
    assert {e: df.columns for e, df in plain.items() if e not in ("portfolio-companies", "deal-pipeline")} == {
        e: df.columns for e, df in entities.items() if e not in ("portfolio-companies", "deal-pipeline")}
    sv = silver.build_silver(bronze)
    assert sv["portfolio_companies"].columns == silver.build_silver(plain)["portfolio_companies"].columns


def test_extra_fields_are_listed_and_kept_together_when_many(spark):
    path = _lines(spark, "t-many", [{"id": i, f"k{i}": i, "s": "x"} for i in range(6)] + ["", "no json", "[1]", '{"id": 9, "s": null}'])
    lines = variants.read_lines(spark, path)
    assert {tuple(r) for r in variants.extra_fields(lines, ["id"]).collect()} == {("s", "string", 6), *((f"k{i}", "bigint", 1) for i in range(6))}
    assert sorted(r["line"] for r in variants.malformed(lines).collect()) == ["[1]", "no json"]
    schema = T.StructType([T.StructField("id", T.LongType())])
    many, names = variants.read_records(spark, path, schema, {"id": "extra"}, max_fields=3)
    assert names == ["extra_extra"]
    assert sorted((tuple(r) for r in many.collect()), key=str) == sorted(
        [(i, f'{{"k{i}":"{i}","s":"x"}}') for i in range(6)] + [(9, None), (None, None), (None, None)], key=str)
    few, names = variants.read_records(spark, path, schema, {"id": "id"})
    assert names == [*(f"k{i}" for i in range(6)), "s"] and few.where("s = 'x'").count() == 6

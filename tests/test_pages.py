"""Pages joined are the view, whatever ties and NULLs its keys have."""

import pytest
from pyspark.sql import functions as F

from fundlake.plans import gold, pages, silver, star, views
from fundlake.session import fresh_dir

from conftest import SF001


def _walk(df, keys, size):
    out, token, n = [], None, 0
    while True:
        got = pages.page(df, keys, size, token)
        out += [tuple(r) for r in got.rows]
        n += 1
        assert len(got.rows) == size or got.token is None
        if got.token is None:
            return out, n
        token = got.token


@pytest.mark.parametrize("size", [1, 7, 50, 1000])
def test_pages_join_to_the_order_with_ties_nulls_and_equal_rows(spark, size):
    rows = [(i % 3 or None, (i * 7) % 5 / 2 if i % 4 else None, "x" if i % 2 else None) for i in range(60 if size > 1 else 20)] + [(1, float("nan"), "n")]
    df = spark.createDataFrame(rows, "a int, b double, c string")
    keys = (("a", "ASC"), ("b", "DESC"))
    got, n = _walk(df, keys, size)
    want = df.orderBy(F.col("a").asc_nulls_last(), F.col("b").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in df.columns])
    assert list(map(str, got)) == [str(tuple(r)) for r in want.collect()] and n == -(-len(rows) // size)


def test_pages_of_the_views_equal_the_views(spark):
    pc = silver.portfolio_companies(star.holdings(spark, SF001), star.STAR_AS_OF_YEAR)
    fin = silver.company_financials(star.revenue(spark, SF001), star.ebitda(spark, SF001))
    made = {"portfolio_table": gold.portfolio_table(pc, fin), "company_financials": gold.company_financials(fin),
            "nav_history": gold.nav_history(silver.fund_history(star.fund_history(spark, SF001))),
            "risk_leverage_bands": gold.risk_leverage_bands(pc)}
    path = fresh_dir(spark, "t-pages")
    tables = {}
    for name, df in made.items():
        df.write.parquet(f"{path}/{name}")
        tables[name] = spark.read.parquet(f"{path}/{name}")
    for view, size in (("portfolio", 40), ("all_financials", 300), ("nav_history", 10), ("leverage_bands", 3)):
        got, token = [], None
        while True:
            part = pages.serve_page(spark, view, size, token, tables)
            got += [tuple(r) for r in part.rows]
            if (token := part.token) is None:
                break
        assert got == [tuple(r) for r in views.serve(spark, view, tables).collect()], view


def test_a_later_page_pushes_its_key_down_and_sorts_with_a_limit(spark):
    path = fresh_dir(spark, "t-pages-plan")
    spark.range(10_000).selectExpr("id AS company_id", "id % 7 AS year", "false AS is_estimate").write.parquet(path)
    df = spark.read.parquet(path)
    first = pages.page(df, pages.VIEW_KEYS["all_financials"], 20)
    plan = pages.page_rows(df, pages.VIEW_KEYS["all_financials"], 20, first.token)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThan(company_id,19)" in plan
    assert pages.page(df.limit(0), pages.VIEW_KEYS["all_financials"], 5) == pages.Page([], None)

"""Every registered query at sf0.01 against its DuckDB oracle (multisets)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

from conftest import SF01

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert r["match"], r


def test_every_query_without_oracle_runs(spark):
    for name in sorted(set(QUERIES) - set(ORACLE)):
        assert QUERIES[name](spark, SF01).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["leverage_band", "company_count", "fmv_m"]

"""IRR: rates outside any fixed range, several roots, keys that are NULL or very large."""

import numpy as np
import pytest

from fundlake.operators import irr, irr_check
from fundlake.operators.returns import solve_irr


def rate(*flows):
    t, cf = (np.array(x, float) for x in zip(*flows))
    return solve_irr(t, cf, np.zeros(len(t), int), 1)[0]


def test_rates_far_from_zero_are_bracketed():
    assert rate((0, -100), (1, 110)) == pytest.approx(0.1)
    assert rate((0, -100), (1 / 365, 110)) == pytest.approx(1.1 ** 365 - 1, rel=1e-9)
    assert rate((0, -1), (1 / 365, 1e9)) == float("inf")
    assert rate((0, -1e12), (0.1, 1e-6)) == pytest.approx(-1.0)
    assert rate((0, -1e5), (5, 1.0)) == pytest.approx(-0.9)
    assert np.isnan(rate((0, 5), (1, 6))) and np.isnan(rate((0, -5), (1, 0)))
    assert np.isnan(rate((0, 10), (1, -1), (2, 10)))


def test_two_roots_in_one_cell_are_found():
    # roots at 2 % and 5 %, both inside one cell of the grid
    a, b = 1.02, 1.05
    got = rate((0, 100), (1, -100 * (a + b)), (2, 100 * a * b))
    assert min(abs(got - 0.02), abs(got - 0.05)) < 1e-6


def test_null_and_large_keys(spark):
    rows = [(None, "2020-01-01", -100.0), (None, "2021-01-01", 110.0), (0, "2020-01-01", -100.0), (0, "2020-12-31", 120.0),
            (9007199254740993, "2020-01-01", -100.0), (9007199254740993, "2020-12-31", 130.0),
            (9007199254740992, "2020-01-01", -100.0), (9007199254740992, None, 130.0)]
    flows = spark.createDataFrame(rows, "k long, d string, x double")
    got = {r["k"]: (r["irr_pct"], r["n_flows"]) for r in irr(flows, "k", "d", "x").collect()}
    assert got == {None: (9.97, 2), 0: (20.0, 2), 9007199254740993: (30.0, 2), 9007199254740992: (None, 1)}
    checked = {r["k"]: r["solved"] for r in irr_check(flows, "k", "d", "x").collect()}
    assert checked == {None: True, 0: True, 9007199254740993: True}

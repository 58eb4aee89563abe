"""All IRR roots: constructed ones, polynomials, bounds and parity, awkward keys."""

import numpy as np
import pytest

from fundlake.operators.roots import irr_roots, solve_all


def rates(*flows):
    t, cf = (np.array(x, float) for x in zip(*flows, strict=True))
    places, changes, unresolved = solve_all(t, cf, np.zeros(len(t), int), 1)
    return np.expm1(places[0]), int(changes[0]), int(unresolved[0])


def product(*factors, scale=-1000.0):
    """Yearly flows whose rates are the factors less one."""
    return list(enumerate(scale * np.poly(factors)))


def test_constructed_roots_are_all_found():
    for factors in ([1.1], [1.02, 1.05], [1.02, 1.05, 1.3], [0.2, 0.9, 1.0, 4.0], [1.1, 1.1001], [0.01, 100.0], [1.0]):
        got, changes, unresolved = rates(*product(*factors))
        assert got == pytest.approx(np.array(sorted(factors)) - 1, abs=1e-7) and changes == len(factors) and not unresolved


def test_no_roots_and_touching_ones():
    assert rates((0, 5), (1, 6))[:2] == (pytest.approx([]), 0)
    got, changes, _ = rates((0, 10), (1, -1), (2, 10))
    assert len(got) == 0 and changes == 2
    got, changes, unresolved = rates(*product(1.5, 1.5))
    assert changes == 2 and (len(got) == 2 or unresolved)
    assert rates((0, 0.0), (1, 0.0)) == (pytest.approx([]), 0, 0)


def test_far_rates():
    assert rates((0, -1e12), (0.1, 1e-6))[0] == pytest.approx([-1.0])
    assert rates((0, -1), (1 / 365, 1e9))[0] == pytest.approx([np.inf])
    assert rates((0, -100), (1 / 365, 110))[0] == pytest.approx([1.1 ** 365 - 1], rel=1e-9)


def test_many_groups_against_polynomial_roots():
    rng = np.random.default_rng(5)
    t, cf, g, want = [], [], [], []
    for i in range(400):
        n = int(rng.integers(1, 9))
        flows = np.round(rng.normal(size=n) * 100) * (rng.random(n) < 0.8)
        t += range(n)
        cf += flows.tolist()
        g += [i] * n
        z = np.roots(flows) if np.any(flows) else np.zeros(0)
        want.append(np.sort(z[(np.abs(z.imag) < 1e-7) & (z.real > 1e-9)].real))
    places, changes, unresolved = solve_all(np.array(t, float), np.array(cf), np.array(g), 400)
    assert len(places) == 400 and unresolved.sum() == 0
    for x, v, z in zip(places, changes, want, strict=True):
        assert np.exp(x) == pytest.approx(z, rel=1e-5) and len(x) <= v and (v - len(x)) % 2 == 0
    # groups do not depend on each other
    one = solve_all(np.array(t, float)[:20], np.array(cf)[:20], np.array(g)[:20], g[19] + 1)[0]
    assert all(a == pytest.approx(b, abs=1e-12) for a, b in zip(one[:-1], places, strict=False))


def test_keys_of_a_table(spark):
    rows = [(None, "2020-01-01", -100.0), (None, "2020-12-31", 110.0), (7, "2019-01-01", -100.0), (7, "2020-01-01", 230.0), (7, "2020-12-31", -132.0),
            (8, "2020-01-01", 5.0), (9, None, 1.0), (10, "2020-01-01", 0.0), (11, "2020-01-01", 1.0), (11, "2020-01-01", -1.0)]
    got = {r["k"]: (r["sign_changes"], r["n_roots"], r["irr_pct"], r["roots_pct"])
           for r in irr_roots(spark.createDataFrame(rows, "k long, d string, x double"), "k", "d", "x", partitions=2).collect()}
    assert got == {None: (1, 1, 10.0, [10.0]), 7: (2, 2, 10.0, [10.0, 20.0]), 8: (0, 0, None, []), 10: (0, 0, None, []), 11: (0, 0, None, [])}

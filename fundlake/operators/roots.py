"""All rates at which a key's dated flows are worth nothing (X2): how many there are, and each of them.

With x = log(1 + rate) the value is a sum of exponentials, sum(cf * exp(-x t)).
The number of sign changes of its flows in time order bounds the number of its
roots, and has the same parity.  Both half lines are searched from x = 0: for
x < 0 the flows are read backwards in time, so no factor exceeds 1, and the
first flow read decides the sign beyond a bound that is found by doubling.

A cell of a half line is settled once the value cannot vanish in it, or once it
is monotone (then the signs at its ends tell whether it holds a root); else it
is halved.  Ranges come from the positive and the negative flows, whose sums
both fall with x: the value lies between ``P(b) - N(a)`` and ``P(a) - N(b)``.
Cells still open at a width of 1e-9 are counted as ``unresolved`` unless their
ends differ in sign: there the value touches zero, or two roots are that close.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators import returns
from fundlake.operators.returns import netted, whole_keys

_NARROW = 1e-9
_BISECT_STEPS = 90
# Flows that one evaluation expands at once.
_AT_ONCE = 4_000_000


@dataclass(frozen=True)
class Flows:
    """Nonzero flows of many keys: those of key i lie at ``starts[i]``, ``counts[i]`` of them, ``tau`` years from the first one read."""

    tau: np.ndarray
    cf: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    def sums(self, x: np.ndarray, key: np.ndarray) -> np.ndarray:
        """At each (x, key): the positive and the negative flows' discounted sums, and both weighted by time."""
        out = np.zeros((4, len(x)))
        size = np.cumsum(self.counts[key])
        a = 0
        while a < len(x):
            b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + _AT_ONCE, side="right")))
            n = self.counts[key[a:b]]
            owner = np.repeat(np.arange(b - a), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.starts[key[a:b]], n)
            tau, cf = self.tau[at], self.cf[at]
            discount = np.exp(-x[a:b][owner] * tau)
            up, down = np.maximum(cf, 0) * discount, np.maximum(-cf, 0) * discount
            out[:, a:b] = [np.bincount(owner, w, b - a) for w in (up, down, up * tau, down * tau)]
            a = b
        return out

    def beyond(self) -> np.ndarray:
        """Per key an x above which the flow at tau = 0 decides the sign."""
        n = len(self.starts)
        x, key = np.ones(n), np.arange(n)
        lead = np.abs(self.cf[self.starts])
        for _ in range(60):
            up, down, _, _ = self.sums(x[key], key)
            key = key[up + down >= 2 * lead[key]]
            if not len(key):
                break
            x[key] *= 2
        return x


def _signs(sums: np.ndarray) -> np.ndarray:
    """True where the value is not negative."""
    return sums[0] >= sums[1]


def isolate(flows: Flows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, low, high) of cells of x >= 0 that hold one sign change each, and the keys of unresolved cells."""
    n = len(flows.starts)
    key, a, b = np.arange(n), np.zeros(n), flows.beyond()
    at_a, at_b = flows.sums(a, key), flows.sums(b, key)
    found, open_ = [], []
    while len(key):
        # the rounding of a sum of that many terms
        slack = 2.0 ** -52 * (flows.counts[key] + 8)
        e, e1 = slack * (at_a[0] + at_a[1]), slack * (at_a[2] + at_a[3])
        clear = (at_b[0] - at_a[1] > e) | (at_a[0] - at_b[1] < -e)
        monotone = (at_b[3] - at_a[2] > e1) | (at_a[3] - at_b[2] < -e1)
        narrow = b - a <= _NARROW * np.maximum(1.0, a)
        change = _signs(at_a) != _signs(at_b)
        hit = ~clear & (monotone | narrow) & change
        found.append((key[hit], a[hit], b[hit]))
        open_.append(key[~clear & ~monotone & narrow & ~change])
        rest = ~clear & ~monotone & ~narrow
        key, a, b, at_a, at_b = key[rest], a[rest], b[rest], at_a[:, rest], at_b[:, rest]
        mid = 0.5 * (a + b)
        at_mid = flows.sums(mid, key)
        key, a, b = np.r_[key, key], np.r_[a, mid], np.r_[mid, b]
        at_a, at_b = np.hstack([at_a, at_mid]), np.hstack([at_mid, at_b])
    return (*(np.concatenate([f[i] for f in found]) for i in range(3)), np.concatenate(open_)) if found else (
        np.zeros(0, int), np.zeros(0), np.zeros(0), np.zeros(0, int))


def refine(flows: Flows, key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The place of each cell's sign change, by bisection."""
    low, high = low.copy(), high.copy()
    at_low = _signs(flows.sums(low, key))
    for _ in range(_BISECT_STEPS):
        mid = 0.5 * (low + high)
        same = _signs(flows.sums(mid, key)) == at_low
        low, high = np.where(same, mid, low), np.where(same, high, mid)
    return 0.5 * (low + high)


def solve_all(t: np.ndarray, cf: np.ndarray, g: np.ndarray, n: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per group: all x = log(1 + rate), ascending; the sign changes of its flows; unresolved cells.

    ``g`` is the group (0 to n - 1, ascending) of every flow, ``t`` its time in
    years, ascending within a group.
    """
    live = cf != 0
    t, cf, g = t[live], cf[live], g[live]
    counts = np.bincount(g, minlength=n)
    changes = np.bincount(g[1:], weights=(g[1:] == g[:-1]) & (np.sign(cf[1:]) != np.sign(cf[:-1])), minlength=n).astype(np.int64) if len(g) else np.zeros(n, np.int64)
    held = np.flatnonzero(counts)
    starts, counts = (np.cumsum(counts) - counts)[held], counts[held]
    unresolved = np.zeros(n, np.int64)
    keys, places = [], []
    if len(held):
        own = np.repeat(np.arange(len(held)), counts)
        later = Flows(t - t[starts][own], cf, starts, counts)
        # backwards in time: the last flow first
        ends = starts + counts - 1
        back = ends[own] - (np.arange(len(t)) - starts[own])
        sooner = Flows(t[ends][own] - t[back], cf[back], starts, counts)
        for side, flows in ((1.0, later), (-1.0, sooner)):
            key, low, high, open_ = isolate(flows)
            keys.append(held[key])
            places.append(side * refine(flows, key, low, high))
            unresolved += np.bincount(held[open_], minlength=n)
    key, place = (np.concatenate(keys), np.concatenate(places)) if keys else (np.zeros(0, int), np.zeros(0))
    order = np.lexsort((place, key))
    return np.split(place[order], np.cumsum(np.bincount(key, minlength=n))[:-1]) if n else [], changes, unresolved


def _frame(pdf: pd.DataFrame) -> pd.DataFrame:
    keys, nulls = pdf["key"].to_numpy(), pdf["no_key"].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])])
    g = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(keys)]))
    days = pd.to_datetime(pdf["flow_date"]).to_numpy().astype("datetime64[D]").astype(np.int64)
    places, changes, unresolved = solve_all((days - days[starts][g]) / 365.0, pdf["amount"].to_numpy(dtype=float), g, len(starts))
    with np.errstate(over="ignore"):
        rates = [np.expm1(x) * 100.0 for x in places]
    nearest = [float(r[np.argmin(np.abs(x))]) if len(x) else None for x, r in zip(places, rates, strict=True)]
    return pd.DataFrame({"key": keys[starts], "no_key": nulls[starts], "sign_changes": changes, "n_roots": [len(x) for x in places],
                         "unresolved": unresolved, "irr_pct": pd.Series(nearest, dtype=float), "roots_pct": [r.tolist() for r in rates]})


def _partition(batches):
    return whole_keys(batches, _frame)


def irr_roots(flows: DataFrame, key: str, date, amount, out_key: str | None = None, scale: int | None = 2,
              partitions: int | None = None) -> DataFrame:
    """Per key: ``sign_changes`` of its net flows, ``n_roots``, ``unresolved`` cells, ``irr_pct`` (the root nearest a
    rate of zero, by log(1 + rate); NULL without one) and ``roots_pct``, all of them in ascending order.

    Netting, partitioning and NULL keys as in :func:`fundlake.operators.irr`.
    """
    # Ship both modules by value: executors need not have this package.
    for module in (returns, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    net, key_type = netted(flows, key, date, amount, partitions)
    found = net.mapInPandas(_partition, f"key {key_type}, no_key boolean, sign_changes long, n_roots long, unresolved long, "
                                        "irr_pct double, roots_pct array<double>")

    def rounded(c):
        return c if scale is None else F.round(c, scale)

    return found.select(F.when(~F.col("no_key"), F.col("key")).alias(out_key or key), "sign_changes", "n_roots", "unresolved",
                        rounded(F.when(~F.isnan("irr_pct"), F.col("irr_pct"))).alias("irr_pct"),
                        F.transform("roots_pct", rounded).alias("roots_pct"))

"""Deterministic numeric helpers.

Money stays ``double`` in and out, but sums go through an exact decimal so
that the result does not depend on how rows are partitioned or in which order
partial sums are merged (a double sum does).  A value that the decimal cannot
hold to nine digits (NaN, an infinity, a very large or very small one) makes
its whole sum a double sum, so nothing is dropped.  Rounding is Spark's
``round`` on the double, once.

Each helper exists in two forms: ``sql_*`` builds Spark SQL text (one
``expr`` per finished expression keeps driver-side plan building cheap), and
the Column form wraps it for column names or accepts a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type of the exact intermediate: 26 digits before the point, 12 after it.
EXACT_TYPE = "decimal(38,12)"


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_round(x: str, scale: int = 2) -> str:
    """HALF_UP round of the double SQL expression ``x``; NaN and infinities pass through."""
    return f"round({x}, {scale})"


def sql_exact(x: str) -> str:
    """``x`` as the exact decimal; NULL where it does not fit."""
    return f"try_cast(({x}) AS {EXACT_TYPE})"


def sql_inexact(x: str) -> str:
    """Whether the non-null ``x`` does not fit the exact decimal to nine digits."""
    return (f"(({x}) IS NOT NULL AND ({sql_exact(x)} IS NULL "
            f"OR abs(CAST({sql_exact(x)} AS DOUBLE) - ({x})) > 1e-9D * abs({x})))")


def sql_sum(x: str) -> str:
    """Sum of double expression ``x`` as double: exact and order-independent
    if every value fits the exact decimal, else the plain double sum."""
    return (f"CASE WHEN count_if({sql_inexact(x)}) = 0 "
            f"THEN coalesce(CAST(try_sum({sql_exact(x)}) AS DOUBLE), sum(CAST(({x}) AS DOUBLE))) "
            f"ELSE sum(CAST(({x}) AS DOUBLE)) END")


def sql_avg(x: str) -> str:
    """Mean as sum / non-null count."""
    return f"try_divide({sql_sum(x)}, CAST(count({x}) AS DOUBLE))"


def sql_div(num: str, den: str) -> str:
    """Division that yields NULL for a zero or NULL divisor (ANSI-safe)."""
    return f"try_divide({num}, {den})"


def to_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_round(c, scale: int = 2) -> Column:
    """``round(c, scale)`` HALF_UP of a double; NaN/inf pass through."""
    return F.round(to_col(c).cast("double"), scale)


def exact_sum(c) -> Column:
    """Column form of :func:`sql_sum` (NULL for no non-null input)."""
    if isinstance(c, str):
        return F.expr(sql_sum(q(c)))
    x = c.cast("double")
    exact = c.try_cast(EXACT_TYPE)
    bad = c.isNotNull() & (exact.isNull() | (F.abs(exact.cast("double") - x) > F.abs(x) * 1e-9))
    return F.when(F.count_if(bad) == 0, F.coalesce(F.try_sum(exact).cast("double"), F.sum(x))
                  ).otherwise(F.sum(x))


def exact_avg(c) -> Column:
    """Mean as exact sum / non-null count, both as double."""
    if isinstance(c, str):
        return F.expr(sql_avg(q(c)))
    return F.try_divide(exact_sum(c), F.count(c).cast("double"))


def safe_div(num, den) -> Column:
    """Division that yields NULL for a zero or NULL divisor (ANSI-safe)."""
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(sql_div(q(num), q(den)))
    return F.try_divide(to_col(num), to_col(den))

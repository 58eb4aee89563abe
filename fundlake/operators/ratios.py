"""Row-wise derived metrics (D1-D10) and guarded ratios (C4).

Arguments are column names (or Columns); with names, each derived column is
one SQL expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import exact_round, q, safe_div, sql_div, sql_round, to_col


def _names(*cols) -> bool:
    return all(isinstance(c, str) for c in cols)


def ratio(df: DataFrame, num, den, out: str, scale: int | None = 2, factor: float = 1.0,
          require_positive: bool = False) -> DataFrame:
    """``out = round(num / den * factor, scale)``; NULL for a zero/NULL divisor.

    ``require_positive`` keeps the value only where ``den > 0`` (CASE without
    ELSE, e.g. leverage and margin).
    """
    if _names(num, den):
        e = sql_div(q(num), q(den))
        if factor != 1.0:
            e = f"{e} * {float(factor)!r}D"
        if scale is not None:
            e = sql_round(e, scale)
        if require_positive:
            e = f"CASE WHEN {q(den)} > 0 THEN {e} END"
        return df.withColumn(out, F.expr(e))
    qv = safe_div(num, den)
    if factor != 1.0:
        qv = qv * F.lit(factor)
    if scale is not None:
        qv = exact_round(qv, scale)
    if require_positive:
        qv = F.when(to_col(den) > 0, qv)
    return df.withColumn(out, qv)


def _binary(df, a, b, op: str, out: str, scale, divisor: float = 1.0) -> DataFrame:
    if _names(a, b):
        e = f"{q(a)} {op} {q(b)}"
        if divisor != 1.0:
            e = f"{e} / {float(divisor)!r}D"
        return df.withColumn(out, F.expr(sql_round(e, scale) if scale is not None else e))
    ca, cb = to_col(a), to_col(b)
    v = {"-": ca - cb, "+": ca + cb, "*": ca * cb}[op]
    if divisor != 1.0:
        v = v / F.lit(divisor)
    return df.withColumn(out, exact_round(v, scale) if scale is not None else v)


def difference(df: DataFrame, a, b, out: str, scale: int | None = 2) -> DataFrame:
    """``out = round(a - b, scale)``."""
    return _binary(df, a, b, "-", out, scale)


def total(df: DataFrame, a, b, out: str, scale: int | None = 2) -> DataFrame:
    """``out = round(a + b, scale)``."""
    return _binary(df, a, b, "+", out, scale)


def product(df: DataFrame, a, b, out: str, divisor: float = 1.0, scale: int | None = 2) -> DataFrame:
    """``out = round(a * b / divisor, scale)`` (e.g. probability-weighted equity)."""
    return _binary(df, a, b, "*", out, scale, divisor)


def years_held(df: DataFrame, col, as_of_year: int, out: str = "holding_years") -> DataFrame:
    """``out = as_of_year - col``."""
    if isinstance(col, str):
        return df.withColumn(out, F.expr(f"{int(as_of_year)} - {q(col)}"))
    return df.withColumn(out, F.lit(as_of_year) - to_col(col))

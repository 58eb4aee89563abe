"""Lenient text -> typed casts (malformed or empty text becomes NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.functions.numeric import q

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def sql_lenient_cast(x: str, dtype: T.DataType, int_via_decimal: bool = True) -> str:
    """SQL text casting expression ``x`` to ``dtype`` without failing under ANSI.

    Integers that are not plain digits go through a decimal, so that
    ``'12.0'`` reads as 12 (as a non-ANSI cast does) while every digit of a
    large identifier is kept.  Dates use ``try_to_date`` on ISO text.
    """
    t = dtype.simpleString()
    if isinstance(dtype, T.StringType):
        return f"CAST({x} AS STRING)"
    if isinstance(dtype, T.DateType):
        return f"try_to_date(CAST({x} AS STRING))"
    if isinstance(dtype, _INTEGRAL) and int_via_decimal:
        return f"coalesce(try_cast({x} AS {t}), try_cast(try_cast({x} AS DECIMAL(38,6)) AS {t}))"
    if isinstance(dtype, T.DoubleType):
        # the JVM's parser also takes a type suffix ('12D') and hexadecimal
        return f"CASE WHEN CAST({x} AS STRING) NOT RLIKE '[0-9.][dDfF][ ]*$|[xX]' THEN try_cast({x} AS {t}) END"
    return f"try_cast({x} AS {t})"


def lenient_cast(c, dtype: T.DataType, int_via_decimal: bool = True) -> Column:
    """Column form of :func:`sql_lenient_cast` (``c``: name or Column)."""
    if isinstance(c, str):
        return F.expr(sql_lenient_cast(q(c), dtype, int_via_decimal))
    if isinstance(dtype, T.StringType):
        return c.cast("string")
    if isinstance(dtype, T.DateType):
        return F.try_to_date(c.cast("string"))
    if isinstance(dtype, _INTEGRAL) and int_via_decimal:
        return F.coalesce(c.try_cast(dtype), c.try_cast("decimal(38,6)").try_cast(dtype))
    if isinstance(dtype, T.DoubleType):
        return F.when(~c.cast("string").rlike("[0-9.][dDfF][ ]*$|[xX]"), c.try_cast(dtype))
    return c.try_cast(dtype)

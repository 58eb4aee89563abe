"""Typed decoding of text results (S11) and column type inference.

Per column, not per cell: one aggregation over the text decides the
narrowest of boolean / bigint / double / string that every present value
casts to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from fundlake.functions.numeric import q

# Candidate types, narrowest first.
CANDIDATES = ("boolean", "bigint", "double")


def _present(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


# Every text that casts to a bigint or double looks like this (not the other way round).  A cast throws and
# catches an exception for each text that it does not take, many times the cost of the look.
_EDGE = "[^0-9A-Za-z.+-]*+"
_INTEGER = f"^{_EDGE}[+-]?[0-9]++{_EDGE}$"
_NUMBER = (f"^{_EDGE}[+-]?(([0-9]++([.][0-9]*+)?|[.][0-9]++)([eE][+-]?[0-9]++)?[dDfF]?"
           f"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN]){_EDGE}$")


def sql_number(x: str) -> str:
    """Text ``x`` as a double; NULL for what only the JVM's parser takes as one (a type suffix as in '12D', hexadecimal)."""
    return f"CASE WHEN {x} RLIKE '{_NUMBER}' AND {x} NOT RLIKE '[0-9.][dDfF][ ]*$|[xX]' THEN try_cast({x} AS DOUBLE) END"


def cell_class(x: str) -> str:
    """Bitmask of the candidate types that a present cell casts to: an integer is a double too, a
    cell that is neither can only be a boolean."""
    return (f"CASE WHEN (CASE WHEN {x} RLIKE '{_INTEGER}' THEN try_cast({x} AS BIGINT) END) IS NOT NULL THEN 6 WHEN ({sql_number(x)}) IS NOT NULL THEN 4 "
            f"WHEN lower(trim({x})) IN ('true', 'false') THEN 1 ELSE 0 END")


def infer_types(df: DataFrame) -> DataFrame:
    """(column_name, inferred_type, present_rows) for every column of ``df``.

    Each present cell gets a bitmask of the candidate types it casts to, once;
    ``bit_and`` over the column keeps the types every value fits.  One global
    aggregate (partial per partition, so it scales with the table), then one
    small row per column.
    """
    cells, aggs = [], []
    for i, name in enumerate(df.columns):
        x = f"CAST({q(name)} AS STRING)"
        cells.append(f"CASE WHEN {_present(x)} THEN {cell_class(x)} END AS `c{i}`")
        aggs += [f"count(`c{i}`) AS `n{i}`", f"bit_and(`c{i}`) AS `m{i}`"]
    one = df.selectExpr(*cells).selectExpr(*aggs)
    rows = []
    for i, name in enumerate(df.columns):
        arms = " ".join(f"WHEN `m{i}` & {1 << b} <> 0 THEN '{t}'"
                        for b, t in enumerate(CANDIDATES))
        label = name.replace("'", "\\'")
        rows.append(f"struct('{label}' AS column_name, "
                    f"CASE WHEN `n{i}` = 0 THEN 'string' {arms} ELSE 'string' END "
                    f"AS inferred_type, `n{i}` AS present_rows)")
    return one.selectExpr(f"inline(array({', '.join(rows)}))")


def decode(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast text columns to their inferred (or given) types; empty -> NULL.

    Inference runs one aggregation and returns one small row per column
    (bounded by the schema width, not by the data).
    """
    if types is None:
        types = {r["column_name"]: r["inferred_type"] for r in infer_types(df).collect()}
    exprs = []
    for name in df.columns:
        x = f"CAST({q(name)} AS STRING)"
        t = types.get(name, "string")
        if t == "boolean":
            v = f"lower(trim({x})) = 'true'"
        elif t == "string":
            v = x
        elif t == "double":
            v = sql_number(x)
        else:
            v = f"try_cast({x} AS {t.upper()})"
        exprs.append(f"CASE WHEN {_present(x)} THEN {v} END AS {q(name)}")
    return df.selectExpr(*exprs)

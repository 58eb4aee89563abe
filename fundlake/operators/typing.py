"""Typed projection of text tables (P1-P9) and cast rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fundlake.functions.casting import sql_lenient_cast
from fundlake.functions.numeric import q


def _typed_sql(src: T.DataType, field: T.StructField, int_via_decimal: bool) -> str:
    name = q(field.name)
    if isinstance(src, T.StringType):
        return sql_lenient_cast(name, field.dataType, int_via_decimal)
    if src == field.dataType:
        return name
    return f"try_cast({name} AS {field.dataType.simpleString()})"


def _sql_value(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "\\'") + "'"
    return repr(v)


def typed_select(df: DataFrame, schema: T.StructType, int_via_decimal: bool = True,
                 defaults: Mapping[str, object] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Select exactly the schema's columns, cast leniently, in schema order, then ``keep`` as they are.

    Text input is cast with :func:`lenient_cast` (malformed -> NULL).  A
    column missing from ``df`` is an error unless ``defaults`` names a value
    for it; ``defaults`` also replaces NULLs (e.g. ``realized`` -> 0).
    """
    defaults = dict(defaults or {})
    src = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        if f.name in src:
            e = _typed_sql(src[f.name], f, int_via_decimal)
            if f.name in defaults:
                e = f"coalesce({e}, CAST({_sql_value(defaults[f.name])} AS {t}))"
        elif f.name in defaults:
            e = f"CAST({_sql_value(defaults[f.name])} AS {t})"
        else:
            raise ValueError(f"column {f.name!r} missing from input")
        exprs.append(f"{e} AS {q(f.name)}")
    return df.selectExpr(*exprs, *[q(c) for c in keep])


def cast_rejects(df: DataFrame, schema: T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """Quarantine rows: one row per cell whose text is present but does not cast.

    Output columns: ``keys...``, ``column_name``, ``raw_value``.  Narrow
    (no shuffle): an array of candidate structs per row, exploded, filtered.
    """
    cells = []
    for f in schema.fields:
        if f.name not in df.columns or isinstance(f.dataType, T.StringType):
            continue
        raw = f"CAST({q(f.name)} AS STRING)"
        bad = (f"{raw} IS NOT NULL AND trim({raw}) <> '' AND "
               f"{sql_lenient_cast(raw, f.dataType)} IS NULL")
        cells.append(f"CASE WHEN {bad} THEN named_struct('column_name', '{f.name}', "
                     f"'raw_value', {raw}) END")
    key_sql = [q(k) for k in keys]
    if not cells:
        arr = "CAST(array() AS array<struct<column_name:string,raw_value:string>>)"
    else:
        arr = f"filter(array({', '.join(cells)}), x -> x IS NOT NULL)"
    return (df.selectExpr(*key_sql, f"explode({arr}) AS _cell")
              .selectExpr(*key_sql, "_cell.column_name", "_cell.raw_value"))


def cast_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per-column validation report in one pass: rows, present, typed, rejected."""
    fields = [f for f in schema.fields
              if f.name in df.columns and not isinstance(f.dataType, T.StringType)]
    aggs = ["count(1) AS `_rows`"]
    for i, f in enumerate(fields):
        raw = f"CAST({q(f.name)} AS STRING)"
        present = f"({raw} IS NOT NULL AND trim({raw}) <> '')"
        aggs += [f"count_if({present}) AS `p{i}`",
                 f"count_if({present} AND {sql_lenient_cast(raw, f.dataType)} IS NULL) AS `r{i}`"]
    rows = [f"struct('{f.name}' AS column_name, '{f.dataType.simpleString()}' AS target_type, "
            f"`_rows` AS total_rows, `p{i}` AS present_rows, `r{i}` AS rejected_rows)"
            for i, f in enumerate(fields)]
    return df.selectExpr(*aggs).selectExpr(f"inline(array({', '.join(rows)}))")

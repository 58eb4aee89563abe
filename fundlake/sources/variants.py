"""Nested source records with fields that no table names (D17, D18): VARIANT, merged schema, typed columns.

JSON Lines are parsed to VARIANT; the fields outside the known ones are listed
with the type that holds all their values, and become columns of their own:
``bigint``, ``double``, ``boolean`` and ``string`` as such, anything else (objects,
arrays, values of several kinds) as its JSON text.  A source that uses data as
field names would give a column for each; beyond ``MAX_FIELDS`` all of them stay
together as one JSON object in the column ``extra``.

Defined cases: a blank line is no record; a line that is no JSON object has NULL
in every column (``malformed`` lists such lines); a JSON null counts as absent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.operators.reshape import to_snake

MAX_FIELDS = 500
JSON = "json"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, record): JSON Lines as they are, and as VARIANT (NULL where malformed)."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    return lines.select(F.col("value").alias("line"), F.try_parse_json("value").alias("record"))


def malformed(lines: DataFrame) -> DataFrame:
    """Lines that hold no JSON object."""
    return lines.where("record IS NULL OR NOT startswith(schema_of_variant(record), 'OBJECT')").select("line")


def extra_fields(lines: DataFrame, known: Sequence[str]) -> DataFrame:
    """(field, type, present): one row per top-level field outside ``known`` that has a value.

    The merged schema is an aggregate with partial states, so a field that
    every record has is not brought together in one task.
    """
    spark = lines.sparkSession
    fields = lines.select("record").lateralJoin(spark.tvf.variant_explode(F.col("record").outer())).select("key", "value")
    live = fields.where(F.col("key").isNotNull() & ~F.col("key").isin(list(known)) & ~F.is_variant_null("value"))
    merged = live.groupBy(F.col("key").alias("field")).agg(F.schema_of_variant_agg("value").alias("schema"), F.count("*").alias("present"))
    kind = F.regexp_extract("schema", "^[A-Z]+", 0)
    typed = (F.when(kind.isin("DECIMAL", "FLOAT"), "double").when(kind.isin("BIGINT", "DOUBLE", "BOOLEAN", "STRING"), F.lower(kind))
             .otherwise(JSON))
    return merged.select("field", typed.alias("type"), "present")


def _path(field: str) -> str | None:
    """The field's path; None for a name that no path can spell."""
    if '"' not in field:
        return f'$["{field}"]'
    return None if "'" in field else f"$['{field}']"


def _json_text(path: str):
    value = F.try_variant_get("record", path, "variant")
    return F.when(~F.is_variant_null(value), F.to_json(value))


def _names(fields: Sequence[str], taken: Sequence[str]) -> list[str]:
    used, names = {c.lower() for c in taken}, []
    for field in fields:
        name = to_snake(field) or "extra"
        while name.lower() in used:
            name += "_extra"
        used.add(name.lower())
        names.append(name)
    return names


def read_records(spark: SparkSession, path: str, schema: T.StructType, columns: Mapping[str, str],
                 max_fields: int = MAX_FIELDS) -> tuple[DataFrame, list[str]]:
    """(records, names of the extra columns): fields of ``schema`` by their type, and all others as columns.

    ``columns`` maps the schema's fields to the names that they will have, which
    extra columns must not take.
    """
    lines = read_lines(spark, path)
    # one row per field, at most max_fields + 1
    found = sorted(tuple(r) for r in extra_fields(lines, schema.fieldNames()).select("field", "type").limit(max_fields + 1).collect())
    taken = [*schema.fieldNames(), *columns.values()]
    together = len(found) > max_fields or any(_path(f) is None for f, _ in found)
    if together:
        names = _names(["extra"], taken)
        known = F.array(*[F.lit(f) for f in schema.fieldNames()])
        rest = F.map_filter(F.from_json("line", "map<string,string>"), lambda k, v: ~F.array_contains(known, k) & v.isNotNull())
        extra = [F.when(F.size(rest) > 0, F.to_json(rest))]
    else:
        names = _names([f for f, _ in found], taken)
        extra = [_json_text(_path(f)) if kind == JSON
                 else F.try_variant_get("record", _path(f), kind) for f, kind in found]
    read = lines.select(F.from_json("line", schema).alias("r"), *[e.alias(n) for e, n in zip(extra, names, strict=True)])
    return read.select("r.*", *names), names

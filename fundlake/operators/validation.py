"""Validation beyond casts (X3): rules of rows, keys, references and row counts; whole rows go to quarantine.

Rules of one row are conditions; they pass where they are NULL, as a CHECK
constraint does (``present`` is the rule against NULLs).  A unique key marks
every row of a repeated key, a reference every row whose key no parent has;
keys with a NULL pass both.  ``row_change`` concerns the table as a whole.

The rows are read once and written once, each with the names of the rules it
breaks; the report is one aggregate over those names.  Keys that repeat and
the parents' keys are written first, so that their joins are planned with their
true size: a hot key stays where it is below the broadcast threshold, and is
split as skewed above it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions.numeric import q
from fundlake.session import fresh_dir

FAILED = "failed_rules"


@dataclass(frozen=True)
class Rule:
    """``kind``: row (``condition``), unique (``columns``), refers (``columns`` to ``parent``'s) or rows (the table's row count)."""

    name: str
    kind: str
    condition: str = ""
    columns: tuple[str, ...] = ()
    parent: DataFrame | None = None
    parent_columns: tuple[str, ...] = ()
    before: int | None = None
    low: float = 0.0
    high: float = float("inf")


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def holds(name: str, condition: str) -> Rule:
    """Any SQL condition over a row."""
    return Rule(name, "row", condition)


def present(column: str, name: str | None = None) -> Rule:
    return holds(name or f"{column}_present", f"{q(column)} IS NOT NULL")


def in_range(column: str, low=None, high=None, name: str | None = None) -> Rule:
    """Both ends belong to the range; None leaves an end open."""
    ends = [f"{q(column)} >= {_literal(low)}"] * (low is not None) + [f"{q(column)} <= {_literal(high)}"] * (high is not None)
    return holds(name or f"{column}_in_range", " AND ".join(ends) or "true")


def one_of(column: str, values: Sequence, name: str | None = None) -> Rule:
    return holds(name or f"{column}_listed", f"{q(column)} IN ({', '.join(map(_literal, values))})")


def matches(column: str, pattern: str, name: str | None = None) -> Rule:
    """The text holds the regular expression."""
    return holds(name or f"{column}_matches", f"{q(column)} RLIKE {_literal(pattern)}")


def unique(columns: Sequence[str], name: str | None = None) -> Rule:
    return Rule(name or "_".join(columns) + "_unique", "unique", columns=tuple(columns))


def refers(columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str], name: str | None = None) -> Rule:
    return Rule(name or "_".join(columns) + "_known", "refers", columns=tuple(columns), parent=parent, parent_columns=tuple(parent_columns))


def row_change(before: int | None, low: float = 0.5, high: float = 2.0, name: str = "row_change") -> Rule:
    """The table has ``low`` to ``high`` times the rows of before (None: nothing to compare with)."""
    return Rule(name, "rows", before=before, low=low, high=high)


@dataclass(frozen=True)
class Validation:
    """``good`` rows with the table's columns; ``quarantined`` rows with ``failed_rules`` besides; ``report`` of every rule."""

    good: DataFrame
    quarantined: DataFrame
    report: DataFrame


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flagged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with ``failed_rules``: the names of the row, unique and refers rules that a row breaks, in the rules' order."""
    names = [r.name for r in rules]
    if len(set(names)) < len(names):
        raise ValueError(f"rule names repeat: {names}")
    if FAILED in df.columns:
        raise ValueError(f"the table has a column {FAILED!r}")
    out, broken = df, []
    taken = {c.lower() for c in df.columns}
    for i, r in enumerate(rules):
        if r.kind == "row":
            broken.append((r.name, f"NOT coalesce({r.condition}, true)"))
        elif r.kind in ("unique", "refers"):
            mark = f"_rule{i}"
            while mark in taken or any(c.startswith(mark + "_") for c in taken):
                mark += "x"
            keys = [f"{mark}_{j}" for j in range(len(r.columns))]
            if r.kind == "unique":
                found = (df.select(*[F.col(q(c)).alias(k) for c, k in zip(r.columns, keys, strict=True)]).dropna()
                         .groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n"))
                broken.append((r.name, f"{mark} IS NOT NULL"))
            else:
                found = r.parent.select(*[F.col(q(c)).alias(k) for c, k in zip(r.parent_columns, keys, strict=True)]).dropna().distinct()
                whole = " AND ".join(f"{q(c)} IS NOT NULL" for c in r.columns)
                broken.append((r.name, f"{mark} IS NULL AND {whole}"))
            found = _written(found, "rule-keys").withColumn(mark, F.lit(True))
            same = [F.col(q(c)) == F.col(k) for c, k in zip(r.columns, keys, strict=True)]
            out = out.join(found, same, "left").drop(*keys)
        elif r.kind != "rows":
            raise ValueError(f"unknown kind of rule {r.kind!r}")
    marks = ", ".join(f"IF({cond}, {_literal(name)}, NULL)" for name, cond in broken)
    failed = f"filter(array({marks}), x -> x IS NOT NULL)" if broken else "CAST(array() AS ARRAY<STRING>)"
    return out.withColumn(FAILED, F.expr(failed)).select(*[F.col(q(c)) for c in df.columns], FAILED)


def validate(df: DataFrame, rules: Sequence[Rule]) -> Validation:
    """Judge every row of ``df``; see :class:`Validation`.

    The report has one row per rule: ``rule``, ``checked_rows``, ``failed_rows``
    (0 for a rule of the whole table) and ``passed``.  An empty table passes all
    rules of rows; its row count is compared like any other.
    """
    rows = _written(flagged(df, rules), "validated")
    aggs = [F.count("*").alias("n")] + [F.count_if(F.array_contains(FAILED, r.name)).alias(f"f{i}") for i, r in enumerate(rules)]
    lines = []
    for i, r in enumerate(rules):
        passed = f"f{i} = 0"
        if r.kind == "rows":
            top = "true" if r.high == float("inf") else f"n <= {r.high!r}D * {r.before}"
            passed = "true" if r.before is None else f"n >= {r.low!r}D * {r.before} AND {top}"
        lines.append(f"named_struct('rule', {_literal(r.name)}, 'checked_rows', n, 'failed_rows', f{i}, 'passed', {passed})")
    if lines:
        report = rows.agg(*aggs).selectExpr(f"inline(array({', '.join(lines)}))")
    else:
        report = df.sparkSession.createDataFrame([], "rule string, checked_rows long, failed_rows long, passed boolean")
    return Validation(rows.where(F.size(FAILED) == 0).drop(FAILED), rows.where(F.size(FAILED) > 0), report)

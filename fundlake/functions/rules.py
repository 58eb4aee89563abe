"""Ordered rule chains: banding and first-match classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.numeric import q, to_col


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v)) + "D"


def sql_bucketize(x: str, edges: Sequence[float], labels: Sequence[str], closed: str = "right",
                  null_label: str | None = None) -> str:
    """SQL CASE labelling ``x`` by ordered edges (see :func:`bucketize_expr`)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have len(edges) + 1 entries")
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    op = "<=" if closed == "right" else "<"
    arms = [f"WHEN {x} IS NULL THEN {_lit(null_label)}"] if null_label is not None else []
    arms += [f"WHEN {x} {op} {_lit(e)} THEN {_lit(lab)}" for e, lab in zip(edges, labels)]
    return f"CASE {' '.join(arms)} ELSE {_lit(labels[-1])} END"


def bucketize_expr(c, edges: Sequence[float], labels: Sequence[str], closed: str = "right",
                   null_label: str | None = None) -> Column:
    """Label ``c`` by ordered edges.

    ``closed="right"`` tests ``c <= edge`` (bands like "up to 3x"),
    ``closed="left"`` tests ``c < edge`` (right-open bands).  ``labels`` has
    one more entry than ``edges``; the last one catches everything else,
    which includes NULL unless ``null_label`` gives NULL its own band.
    """
    if isinstance(c, str):
        return F.expr(sql_bucketize(q(c), edges, labels, closed, null_label))
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have len(edges) + 1 entries")
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    c = to_col(c)
    expr = F.when(c.isNull(), F.lit(null_label)) if null_label is not None else None
    for edge, label in zip(edges, labels):
        cond = c <= F.lit(edge) if closed == "right" else c < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def first_match_expr(rules: Sequence[tuple[Column | str, str]], default: str) -> Column:
    """CASE WHEN rule1 THEN label1 ... ELSE default (NULL conditions do not match).

    Conditions are Columns or SQL text (all text -> one expression)."""
    if all(isinstance(cond, str) for cond, _ in rules):
        arms = " ".join(f"WHEN {cond} THEN {_lit(lab)}" for cond, lab in rules)
        return F.expr(f"CASE {arms} ELSE {_lit(default)} END" if rules else _lit(default))
    expr = None
    for cond, label in rules:
        cond = F.expr(cond) if isinstance(cond, str) else cond
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))

"""Result pages of the serving views, continued by key.

A page's token holds the sort key of its last row and how many rows with just
that key have been served.  The next page asks for rows from that key on, in the
served order, so nothing before it is sorted or counted; only the few rows
that tie with the key are read again.  NULLs come last in every key, as the
views serve them; rows that tie in the whole key go by all their columns, and equal
rows are interchangeable.
"""

from __future__ import annotations

import base64
import datetime
import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from fundlake.functions.numeric import q
from fundlake.plans.views import QUARTER_KEY, VIEW_TABLE

# Sort keys of the ordered views: expression and direction, NULLs last.
VIEW_KEYS: dict[str, tuple[tuple[str, str], ...]] = {
    "nav_history": ((QUARTER_KEY, "ASC"), ("quarter", "ASC")),
    "cashflow": (("row_num", "ASC"),),
    "portfolio": (("fmv", "DESC"), ("id", "ASC")),
    "all_financials": (("company_id", "ASC"), ("year", "ASC"), ("is_estimate", "ASC")),
    "sector_allocation": (("fmv_m", "DESC"), ("sector", "ASC")),
    "geo_allocation": (("fmv_m", "DESC"), ("region", "ASC")),
    "pipeline": (("stage", "ASC"), ("probability", "DESC"), ("id", "ASC")),
    "leverage_bands": (("leverage_band", "ASC"),),
    "moic_bands": (("moic_band", "ASC"),),
}


@dataclass(frozen=True)
class Page:
    rows: list[Row]
    token: str | None  # of the page behind this one; None at the end


def _encode(keys: list, served: int) -> str:
    def plain(v):
        return {"date": v.isoformat()} if isinstance(v, datetime.date) else v
    return base64.urlsafe_b64encode(json.dumps([[plain(k) for k in keys], served]).encode()).decode()


def _decode(token: str) -> tuple[list, int]:
    keys, served = json.loads(base64.urlsafe_b64decode(token))
    return [datetime.date.fromisoformat(k["date"]) if isinstance(k, dict) else k for k in keys], served


def _from(keys: tuple[tuple[str, str], ...], values: list) -> str:
    """SQL text: the row's key is that of the token or after it (parameters ``:k0``, ``:k1``, ...)."""
    arms, equal = [], []
    for i, ((key, direction), value) in enumerate(zip(keys, values, strict=True)):
        if value is not None:
            sign = ">" if direction == "ASC" else "<"
            arms.append(" AND ".join([*equal, f"(({key}) {sign} :k{i} OR ({key}) IS NULL)"]))
        equal.append(f"({key}) IS NULL" if value is None else f"({key}) = :k{i}")
    return " OR ".join(f"({a})" for a in [*arms, " AND ".join(equal)])


def page_rows(df: DataFrame, keys: tuple[tuple[str, str], ...], size: int, after: str | None = None) -> DataFrame:
    """The rows of one page and up to one more, with key columns ``_k0`` ...: a sort with a limit, not a full sort.

    Rows that the token counts as served, and tie with its key, come first.
    """
    args, served, where = {}, 0, ""
    if after is not None:
        values, served = _decode(after)
        args = {f"k{i}": v for i, v in enumerate(values) if v is not None}
        where = f"WHERE {_from(keys, values)}"
    order = [f"({k}) {d} NULLS LAST" for k, d in keys] + [f"{q(c)} ASC NULLS LAST" for c in df.columns]
    named = ", ".join(f"({k}) AS _k{i}" for i, (k, _) in enumerate(keys))
    # braces of a key's patterns are doubled: the statement is a format string, whose one field is the table
    where, named, ordered = (x.replace("{", "{{").replace("}", "}}") for x in (where, named, ", ".join(order)))
    return df.sparkSession.sql(f"SELECT *, {named} FROM {{_t}} {where} ORDER BY {ordered} LIMIT {size + served + 1}", args=args, _t=df)


def page(df: DataFrame, keys: tuple[tuple[str, str], ...], size: int, after: str | None = None) -> Page:
    """One page of ``df`` in the order of ``keys``; the driver gets its rows and those that tie with the token."""
    if size < 1:
        raise ValueError("size must be positive")
    last, served = _decode(after) if after else (None, 0)
    found = page_rows(df, keys, size, after).collect()[served:]
    rows, names = found[:size], [f"_k{i}" for i in range(len(keys))]
    token = None
    if len(found) > size:
        key = [rows[-1][n] for n in names]
        same = sum([r[n] for n in names] == key for r in rows)
        token = _encode(key, same + (served if key == last else 0))
    plain = [c for c in df.columns]
    return Page([Row(**{c: r[c] for c in plain}) for r in rows], token)


def serve_page(spark: SparkSession, view: str, size: int, after: str | None = None,
               tables: Mapping[str, DataFrame] | None = None, database: str | None = None) -> Page:
    """One page of an ordered view over Gold DataFrames or the catalog's tables."""
    if tables is None and database is None:
        raise ValueError("give either tables or database")
    name = VIEW_TABLE[view]
    df = tables[name] if tables is not None else spark.table(f"`{database}`.`{name}`")
    return page(df, VIEW_KEYS[view], size, after)

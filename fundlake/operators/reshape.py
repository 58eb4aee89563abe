"""Reshaping: year-map unpivot (D17), nested -> flat columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: suffix marking an estimated year key ("2026E").
ESTIMATE_SUFFIX = "E"


def unpivot_years(df: DataFrame, id_cols: Sequence[str], map_col: str, value: str,
                  estimate_suffix: str = ESTIMATE_SUFFIX, year: str = "year",
                  estimate: str = "is_estimate") -> DataFrame:
    """``{year_key: value}`` map -> one row per (ids, year).

    The suffix is stripped from the key (``"2026E"`` -> 2026) and marks
    ``is_estimate``; so ``2026`` and ``2026E`` become two rows for one year.
    """
    ex = df.select(*id_cols, F.explode(F.col(map_col)).alias("_k", "_v"))
    key = F.col("_k").cast("string")
    return ex.select(
        *id_cols,
        F.replace(key, F.lit(estimate_suffix), F.lit("")).try_cast("int").alias(year),
        F.contains(key, F.lit(estimate_suffix)).alias(estimate),
        F.col("_v").alias(value))


def to_snake(name: str) -> str:
    """camelCase / PascalCase -> snake_case (``entryEV`` -> ``entry_ev``)."""
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    return s.replace(".", "_").lower()


def _leaves(dtype: T.StructType, prefix: str = "") -> list[str]:
    out = []
    for f in dtype.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType, path + ".")
        else:
            out.append(path)
    return out


def flatten(df: DataFrame, mapping: Mapping[str, str] | None = None,
            defaults: Mapping[str, object] | None = None, keep_prefix: bool = False) -> DataFrame:
    """Nested struct fields -> flat snake_case columns.

    ``mapping`` gives ``{"path.to.field": "out_name"}`` explicitly (only those
    are kept); without it every leaf is kept and named by :func:`to_snake` of
    its last segment (or of the whole path with ``keep_prefix``).
    ``defaults`` replaces NULL/missing values (e.g. ``realized`` -> 0).
    """
    if mapping is None:
        leaves = _leaves(df.schema)
        mapping = {p: to_snake(p if keep_prefix else p.split(".")[-1]) for p in leaves}
    defaults = dict(defaults or {})
    cols = []
    for path, out in mapping.items():
        c = F.col(path)
        if out in defaults:
            c = F.coalesce(c, F.lit(defaults[out]))
        cols.append(c.alias(out))
    return df.select(*cols)

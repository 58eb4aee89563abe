"""Statistics that merge: a stored state for each part of a table, merged without its rows.

A part is what arrives together, such as a load date.  Its rows are summed up
once, to one row per group: exact sums, counts, weighted sums, extremes.  A
statistic over any set of parts is an aggregate of their states, so a new part
costs a scan of that part and nothing of the old ones.  Delivering a part again
replaces its state; a run counts whole or not at all (``sources.snapshot``).

A merged sum follows :func:`fundlake.functions.numeric.sql_sum`: exact and the
same as over all rows at once, unless a value does not fit the exact type; then
it is the double sum of all rows, whose last digits follow the order of adding.

Defined cases: a NULL part is a part of its own; without rows a global result
is one row of NULLs and zero counts, a grouped one is empty; an update without
rows replaces nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.numeric import q, sql_exact, sql_inexact, sql_round
from fundlake.sources.snapshot import LayerRun, current

_PARTS = "parts"


@dataclass(frozen=True)
class Stat:
    """A statistic: accumulators (kind, SQL over a row) and the SQL over their merged values ``{0}``, ``{1}``, ..."""

    name: str
    over: tuple[tuple[str, str], ...]
    final: str = "{0}"


def _final(x: str, scale: int | None) -> str:
    return x if scale is None else sql_round(x, scale)


def total(name: str, x: str, scale: int | None = None) -> Stat:
    """Sum of ``x``."""
    return Stat(name, (("sum", x),), _final("{0}", scale))


def mean(name: str, x: str, scale: int | None = 2) -> Stat:
    """Mean of the non-null ``x``."""
    return Stat(name, (("sum", x), ("count", x)), _final("try_divide({0}, CAST({1} AS DOUBLE))", scale))


def weighted(name: str, x: str, weight: str, null_weights: str = "keep", scale: int | None = 2) -> Stat:
    """Mean of ``x`` by ``weight``; NULL values as in :func:`fundlake.operators.weighted_mean`."""
    if null_weights not in ("keep", "drop"):
        raise ValueError("null_weights must be 'keep' or 'drop'")
    below = weight if null_weights == "keep" else f"CASE WHEN ({x}) IS NOT NULL THEN {weight} END"
    return Stat(name, (("sum", f"({weight}) * ({x})"), ("sum", below)), _final("try_divide({0}, {1})", scale))


def count(name: str, where: str = "true") -> Stat:
    """Number of rows for which ``where`` holds."""
    return Stat(name, (("rows", where),))


def highest(name: str, x: str, scale: int | None = None) -> Stat:
    return Stat(name, (("max", x),), _final("{0}", scale))


def lowest(name: str, x: str, scale: int | None = None) -> Stat:
    return Stat(name, (("min", x),), _final("{0}", scale))


def _partial(kind: str, x: str, at: str) -> dict[str, str]:
    """State fields of one accumulator: aggregates over the rows of a part."""
    if kind == "sum":
        # a sum beyond the exact type counts as a value that does not fit
        beyond = f"IF(count({x}) > 0 AND count_if({sql_inexact(x)}) = 0 AND try_sum({sql_exact(x)}) IS NULL, 1, 0)"
        return {f"{at}_s": f"try_sum({sql_exact(x)})", f"{at}_d": f"sum(CAST(({x}) AS DOUBLE))",
                f"{at}_i": f"count_if({sql_inexact(x)}) + {beyond}"}
    return {at: {"count": f"count({x})", "rows": f"count_if({x})", "max": f"max({x})", "min": f"min({x})"}[kind]}


def _merged(kind: str, at: str) -> str:
    """The accumulator's value: an aggregate over states."""
    if kind == "sum":
        return (f"CASE WHEN coalesce(sum({at}_i), 0) = 0 THEN coalesce(CAST(try_sum({at}_s) AS DOUBLE), sum({at}_d)) "
                f"ELSE sum({at}_d) END")
    return {"count": f"coalesce(sum({at}), 0)", "rows": f"coalesce(sum({at}), 0)", "max": f"max({at})", "min": f"min({at})"}[kind]


@dataclass(frozen=True)
class Grouping:
    """Statistics per value of ``by`` (none: one row over all)."""

    stats: Sequence[Stat]
    by: Sequence[str] = ()

    def accumulators(self) -> list[tuple[str, str]]:
        """Each accumulator once, however many statistics share it."""
        return list(dict.fromkeys(a for s in self.stats for a in s.over))

    def states(self, rows: DataFrame, parts: Sequence[str]) -> DataFrame:
        """One row per part and group."""
        keys = [F.expr(q(c)).alias(f"p{i}") for i, c in enumerate(parts)] + [F.expr(q(c)).alias(f"g{i}") for i, c in enumerate(self.by)]
        fields = {k: v for i, (kind, x) in enumerate(self.accumulators()) for k, v in _partial(kind, x, f"a{i}").items()}
        return rows.groupBy(*keys).agg(*[F.expr(e).alias(k) for k, e in fields.items()])

    def merge(self, states: DataFrame) -> DataFrame:
        """The statistics of the rows behind ``states``."""
        accs = self.accumulators()
        at = {a: f"m{i}" for i, a in enumerate(accs)}
        merged = states.groupBy(*[f"g{i}" for i in range(len(self.by))]).agg(
            *[F.expr(_merged(kind, f"a{i}")).alias(f"m{i}") for i, (kind, _) in enumerate(accs)])
        return merged.selectExpr(*[f"g{i} AS {q(c)}" for i, c in enumerate(self.by)],
                                 *[f"{s.final.format(*[at[a] for a in s.over])} AS {q(s.name)}" for s in self.stats])


@dataclass(frozen=True)
class PartialStats:
    """States below ``root`` of the parts named by the columns ``parts``; ``groupings`` by name.

    A store keeps the groupings that it was made with: other statistics need another root.
    """

    root: str
    parts: Sequence[str]
    groupings: Mapping[str, Grouping]

    def _path(self, run_id: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/states/{run_id}/{name}"

    def _live(self, spark: SparkSession) -> DataFrame | None:
        now = current(spark, self.root)
        return now.read(spark, _PARTS) if now else None

    def _same_part(self, a: DataFrame, b: DataFrame):
        cond = F.lit(True)
        for i in range(len(self.parts)):
            cond = cond & a[f"p{i}"].eqNullSafe(b[f"p{i}"])
        return cond

    def _publish(self, run: LayerRun, parts: DataFrame) -> None:
        # one row per part
        run.write(parts.coalesce(1), _PARTS)
        run.commit()

    def update(self, rows: DataFrame) -> dict[str, int]:
        """Take in the parts in ``rows``, each whole; how many there are, and how many of them replace a state."""
        spark = rows.sparkSession
        old, run = self._live(spark), LayerRun(spark, self.root)
        for name, grouping in self.groupings.items():
            grouping.states(rows, self.parts).withColumn("run", F.lit(run.run_id)).write.parquet(self._path(run.run_id, name))
        first = spark.read.parquet(self._path(run.run_id, next(iter(self.groupings))))
        new = first.select(*[f"p{i}" for i in range(len(self.parts))], "run").distinct()
        after, replaced = new, 0
        if old is not None:
            same = self._same_part(old, new)
            replaced = old.join(new, same, "left_semi").count()
            after = new.unionByName(old.join(new, same, "left_anti"))
        self._publish(run, after)
        return {"parts": new.count(), "replaced": replaced}

    def forget(self, spark: SparkSession, where: str) -> int:
        """Leave out the parts for which ``where`` (SQL over the part columns) holds; how many they were."""
        old, run = self._live(spark), LayerRun(spark, self.root)
        if old is None:
            return 0
        gone = F.coalesce(F.expr(where), F.lit(False))
        named = old.withColumns({c: F.col(f"p{i}") for i, c in enumerate(self.parts)}).withColumn("_gone", gone)
        n = named.where("_gone").count()
        for name in self.groupings:
            # the run's own (empty) states, so that every version has their columns
            self._states(spark, name).limit(0).write.parquet(self._path(run.run_id, name))
        self._publish(run, named.where("NOT _gone").select(*old.columns))
        return n

    def compact(self, spark: SparkSession) -> None:
        """Write the live states of all runs together; results stay, fewer files are read."""
        old, run = self._live(spark), LayerRun(spark, self.root)
        if old is None:
            return
        for name in self.groupings:
            self._states(spark, name).withColumn("run", F.lit(run.run_id)).write.parquet(self._path(run.run_id, name))
        self._publish(run, old.withColumn("run", F.lit(run.run_id)))

    def _states(self, spark: SparkSession, name: str, where: str | None = None) -> DataFrame:
        now = current(spark, self.root)
        if now is None:
            raise LookupError(f"no part has been taken in below {self.root}")
        parts = now.read(spark, _PARTS)
        # one path per run that still counts; the last run's always is there
        runs = sorted({now.run_id, *[r["run"] for r in parts.select("run").distinct().collect()]})
        states = spark.read.parquet(*[self._path(r, name) for r in runs])
        if where is not None:
            named = parts.withColumns({c: F.col(f"p{i}") for i, c in enumerate(self.parts)})
            parts = named.where(where).select(*parts.columns)
        return states.join(parts, self._same_part(states, parts) & (states["run"] == parts["run"]), "left_semi")

    def result(self, spark: SparkSession, name: str, where: str | None = None) -> DataFrame:
        """The statistics of grouping ``name`` over all parts, or those for which ``where`` holds."""
        return self.groupings[name].merge(self._states(spark, name, where))

"""Aggregates kept as a table that follows its source change by change.

The table holds one row of partial states for each group, in partitions by a hash of the group.  ``apply`` folds a set of
changes to one row for each group, before and after one shuffle, and adds it to the states of the buckets it falls in:
counts and sums take inserted and deleted rows alike.  Some states can't give a row back: the least or greatest
value when it is deleted, floating sums, distinct counts.  Only groups where that happens are computed again, from those rows
of the source that a filter of fixed size finds; they are combined before their shuffle, so a hot group is no hot task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.types import type_family
from tidemark.operators.keys import all_of, any_of, is_true, no_null, probably_among
from tidemark.operators.partitions import hash_bucket
from tidemark.plans.load import RUN
from tidemark.plans.partitions import write_partitions
from tidemark.plans.publish import properties_of, replace_table, table_exists
from tidemark.plans.recovery import recover
from tidemark.session import cleaned_up, stage

KINDS = ("count", "sum", "avg", "min", "max", "count_distinct")

BUCKET, ROWS = "_bucket", "_rows"


@dataclass(frozen=True)
class Measure:
    """One aggregate of a column; ``count`` without a column counts rows.

    As in SQL nulls are left out, and of nothing but nulls only counts have a value (0).  ``avg`` is a double.
    """

    kind: str
    column: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"a measure is one of {KINDS}, not {self.kind!r}")
        if self.column is None and self.kind != "count":
            raise ValueError(f"{self.kind} needs a column")

    @property
    def value(self) -> Column:
        return F.col(f"`{self.column}`")


@dataclass(frozen=True)
class AggregateTable:
    """Aggregates of ``source`` by the columns ``by``, in a table of states (see ``read`` for the values).

    Null is a group like any other.  ``buckets``: partitions of the table; a set of changes rewrites those it falls in.
    """

    name: str
    source: Callable[[SparkSession], DataFrame]
    by: Sequence[str]
    measures: Mapping[str, Measure]
    buckets: int = 64
    location: str | None = None

    def __post_init__(self) -> None:
        if isinstance(self.by, str) or not self.by:
            raise ValueError("aggregates need a list of columns to group by")
        if not self.measures:
            raise ValueError("aggregates need a measure")
        taken = [*self.by, *self.measures, BUCKET, ROWS]
        if len({c.lower() for c in taken}) < len(taken):
            raise ValueError(f"the names {taken} clash")

    # -- the table ------------------------------------------------------------------------------------------------

    def create(self, spark: SparkSession) -> None:
        """Build the table, or build it anew, from the whole source."""
        states = self._states(self.source(spark))
        replace_table(states, self.name, partition_by=[BUCKET], location=self.location)

    def read(self, spark: SparkSession) -> DataFrame:
        """The groups and their values."""

        def value(name: str, measure: Measure) -> Column:
            total, n = F.col(f"`s_{name}`"), F.col(f"`n_{name}`")
            if measure.kind == "count":
                return n
            if measure.kind == "sum":
                return F.when(n > 0, total)
            if measure.kind == "avg":
                return F.when(n > 0, total.cast("double") / n)
            return F.col(f"`v_{name}`")

        values = [value(name, m).alias(name) for name, m in self.measures.items()]
        return spark.table(self.name).select(*self._groups(), *values)

    def apply(
        self, changes: DataFrame, operation: str, deletes: Sequence[str] = ("delete",), run_id: str | None = None
    ) -> str:
        """Follow a set of changes; returns 'create', 'apply' or 'skip'.

        ``source`` must read as it is after these changes and before any later ones (a version of it, or a filter): groups that
        are computed again are computed from it.
        ``changes`` holds whole rows: those whose ``operation`` is one of ``deletes`` have left the source, all others
        (null too) are new in it; an update is a pair of both.  Rows may repeat and come late.  Deleting more rows of a
        group than it has is an error, and changes nothing.  With a ``run_id`` a set that the table took last is not taken
        again, so one whose end is not known can be repeated.
        """
        spark = changes.sparkSession
        if not table_exists(spark, self.name):
            self.create(spark)
            return "create"
        recover(spark, self.name)
        if run_id is not None and properties_of(spark, self.name).get(RUN) == run_id:
            return "skip"
        with cleaned_up(spark):
            delta = stage(self._delta(changes, operation, deletes), "delta").frame
            touched = [row[0] for row in delta.select(BUCKET).distinct().collect()]  # at most as many as buckets
            if touched:
                result = self._moved(spark.table(self.name).filter(F.col(BUCKET).isin(touched)), delta)
                marks = {} if run_id is None else {RUN: run_id}
                write_partitions(result, self.name, [(str(b),) for b in touched], marks)
        return "apply"

    # -- states -----------------------------------------------------------------------------------------------------

    def _groups(self) -> list[Column]:
        return [F.col(f"`{c}`") for c in self.by]

    def _states(self, rows: DataFrame) -> DataFrame:
        """The states of a set of rows."""
        out = [F.count(F.lit(1)).alias(ROWS)]
        for name, m in self.measures.items():
            if m.kind in ("count", "sum", "avg"):
                out.append(F.count(F.lit(1) if m.column is None else m.value).alias(f"n_{name}"))
            if m.kind in ("sum", "avg"):
                out.append(F.coalesce(F.sum(m.value), F.lit(0)).cast(_total(rows, m)).alias(f"s_{name}"))
            if m.kind in ("min", "max"):
                out.append((F.min if m.kind == "min" else F.max)(m.value).alias(f"v_{name}"))
            if m.kind == "count_distinct":
                out.append(F.countDistinct(m.value).alias(f"v_{name}"))
        grouped = rows.groupBy(*self._groups()).agg(*out)
        return grouped.withColumn(BUCKET, hash_bucket(list(self.by), self.buckets))

    def _delta(self, changes: DataFrame, operation: str, deletes: Sequence[str]) -> DataFrame:
        """What the changes add to each group's states, and what they may have taken from it."""
        left = is_true(F.col(f"`{operation}`").isin(*deletes))
        sign = F.when(left, -1).otherwise(1)
        out = [F.sum(sign).alias(ROWS)]
        for name, m in self.measures.items():
            if m.kind in ("count", "sum", "avg"):
                out.append(F.sum(sign if m.column is None else F.when(m.value.isNotNull(), sign).otherwise(0)).alias(f"n_{name}"))
            if m.kind in ("sum", "avg"):
                signed = F.when(left, -m.value).otherwise(m.value)
                out.append(F.coalesce(F.sum(signed), F.lit(0)).cast(_total(changes, m)).alias(f"s_{name}"))
                if type_family(changes.schema[m.column].dataType) == "float":
                    out.append(F.max(left & m.value.isNotNull()).alias(f"again_{name}"))
            if m.kind in ("min", "max"):
                best = F.min if m.kind == "min" else F.max
                out.append(best(F.when(~left, m.value)).alias(f"v_{name}"))
                out.append(best(F.when(left, m.value)).alias(f"left_{name}"))
            if m.kind == "count_distinct":
                out.append(F.max(m.value.isNotNull()).alias(f"again_{name}"))
        grouped = changes.groupBy(*self._groups()).agg(*out)
        return grouped.withColumn(BUCKET, hash_bucket(list(self.by), self.buckets))

    def _moved(self, states: DataFrame, delta: DataFrame) -> DataFrame:
        """The states of the touched buckets after the changes."""
        old, new = (lambda c: F.col(f"old.`{c}`")), (lambda c: F.col(f"new.`{c}`"))
        same = all_of([old(c).eqNullSafe(new(c)) for c in (BUCKET, *self.by)])
        here = new(ROWS).isNotNull()
        rows = F.coalesce(old(ROWS), F.lit(0)) + F.coalesce(new(ROWS), F.lit(0))
        short = F.raise_error(F.lit(f"the changes delete rows that {self.name} has not counted"))
        out = {ROWS: F.when(rows < 0, short.cast("bigint")).otherwise(rows)}
        again = []
        for name, m in self.measures.items():
            for state in (f"n_{name}", f"s_{name}"):
                if state in states.columns:
                    # A sum of two decimals has a digit more; the state keeps its type.
                    kind = states.schema[state].dataType
                    out[state] = F.when(~here, old(state)).otherwise(
                        (F.coalesce(old(state), F.lit(0)) + F.coalesce(new(state), F.lit(0))).cast(kind)
                    )
            if m.kind in ("min", "max"):
                best = F.least if m.kind == "min" else F.greatest
                out[f"v_{name}"] = best(old(f"v_{name}"), new(f"v_{name}"))
                # The value that left was the best one, or as good.
                again.append(best(out[f"v_{name}"], new(f"left_{name}")).eqNullSafe(new(f"left_{name}")) & new(f"left_{name}").isNotNull())
            if m.kind == "count_distinct":
                out[f"v_{name}"] = F.coalesce(old(f"v_{name}"), F.lit(0).cast("bigint"))
            if f"again_{name}" in delta.columns:
                again.append(new(f"again_{name}"))
        keys = {c: F.coalesce(old(c), new(c)) for c in (*self.by, BUCKET)}
        columns = [c.alias(n) for n, c in {**keys, **out}.items()]
        redo = (is_true(any_of(again)) if again else F.lit(False)).alias("_again")
        moved = states.alias("old").join(delta.alias("new"), same, "full").select(*columns, redo).filter(F.col(ROWS) != 0)
        if not again:
            return moved.drop("_again").select(states.columns)
        moved = stage(moved, "moved").frame
        wanted = moved.filter("_again").select(*self.by)
        kept = moved.filter("NOT _again").select(states.columns)
        if wanted.isEmpty():
            return kept
        return kept.unionByName(self._recomputed(wanted).select(states.columns))

    def _recomputed(self, wanted: DataFrame) -> DataFrame:
        """The states of some groups from the source.

        Rows are narrowed without a shuffle and combined before theirs; then the few groups let through by chance go.
        """
        source, complete = self.source(wanted.sparkSession), is_true(no_null(self.by))
        rows = probably_among(source, wanted, list(self.by))
        if not wanted.filter(~complete).isEmpty():
            rows = rows.unionByName(source.filter(~complete))
        same = all_of([F.col(f"found.`{c}`").eqNullSafe(F.col(f"wanted.`{c}`")) for c in self.by])
        return self._states(rows).alias("found").join(wanted.alias("wanted"), same, "left_semi")


def _total(rows: DataFrame, measure: Measure) -> T.DataType:
    """The type of a sum, as Spark's own."""
    return rows.select(F.sum(measure.value).alias("total")).schema["total"].dataType

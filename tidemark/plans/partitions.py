"""Publishing partitions: all of a load's partitions change, or none does, whenever the driver dies.

The rows are written into a folder of their own, where no reader looks.  Then the catalog's partitions are pointed to the new
folders one after another.  A journal beside the table says how far that has come:

    <version>.begun      rows are being written; nothing else has changed
    <version>.moves      for each partition the folder it had and the folder it gets; partitions are being pointed anew
    <version>.committed  the load counts; what is left is to drop emptied partitions and the folders that were replaced

Before ``committed`` a publication that was interrupted is undone by ``recover``, which every load calls first: partitions get
their old folders back, and a repeated load starts from what was there before.  From then on ``recover`` finishes it.  Properties
that belong to a load (``marks``) are named in ``committed`` as well, so they hold if and only if its rows do.

A table is written by one application at a time; within it loads of different partitions may overlap.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.keys import all_of, any_of
from tidemark.plans.publish import PATH_FORMATS, Shape, is_below, partition_columns, quoted, set_properties, shape
from tidemark.session import Files
from tidemark.sources.sinks import gathered

#: A partition's values as texts; None for null.
Values = tuple[str | None, ...]

#: The folder below a table's location that holds versions of partitions and the journal; tables don't list it.
PUBLISHED = "_published"

#: Partitions named by one catalog statement, and statements sent at once.
PER_STATEMENT, AT_ONCE = 200, 8

#: How a null partition value is spelled in a folder's name.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"

#: Publications of this application that are under way; they are not to be recovered.
LIVE: set[str] = set()


@dataclass(frozen=True)
class Move:
    """A partition with the folder it had (None: it is new) and the folder it gets (None: it is emptied)."""

    values: Values
    old: str | None
    new: str | None


@dataclass(frozen=True)
class Publication:
    """One change of a table's partitions."""

    spark: SparkSession
    table: str
    kind: Shape
    version: str

    @property
    def files(self) -> Files:
        return Files(self.spark, self.kind.location)

    @property
    def data(self) -> str:
        return f"{_root(self.kind)}/{self.version}"

    def mark(self, state: str) -> str:
        return f"{journal_of(self.kind)}/{self.version}.{state}"

    # -- the steps, in their order ------------------------------------------------------------------------------

    def begin(self) -> None:
        self.files.write(self.mark("begun"), "")

    def write(self, rows: DataFrame) -> dict[Values, str]:
        """Write the rows and tell which partitions they fell in, with their folders."""
        types = {f.name: f.dataType for f in self.spark.table(self.table).schema.fields}
        columns = [F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()]
        self._save(gathered(rows.select(*columns), self.kind.partition_by))
        return dict(self._found(self.data, len(self.kind.partition_by)))

    def keep(self, stays: Sequence[Values]) -> None:
        """Write what the table holds in some partitions beside the new rows."""
        at = list(zip(self.kind.partition_by, zip(*stays, strict=True), strict=True))
        # Pruned to the partitions by their literal values, and then exact.
        likely = all_of([any_of([_is(c, v) for v in dict.fromkeys(values)]) for c, values in at])
        exact = any_of([all_of([_is(c, v) for c, v in zip(self.kind.partition_by, values, strict=True)]) for values in stays])
        self._save(self.spark.table(self.table).filter(likely & exact), mode="append")

    def record(self, written: Mapping[Values, str], emptied: Sequence[Values], known: Mapping[Values, str]) -> list[Move]:
        moves = [Move(v, known.get(v), folder) for v, folder in written.items()]
        moves += [Move(v, known[v], None) for v in emptied if v in known]
        self.files.write(self.mark("moves"), json.dumps([[m.values, m.old, m.new] for m in moves]))
        return moves

    def repoint(self, moves: Sequence[Move]) -> None:
        """Give every partition its new folder; emptied ones get a folder without files, until they may be dropped."""
        nothing = f"{self.data}/_nothing"
        self.files.make(nothing)
        self._add([m for m in moves if m.old is None])
        self._locate([(m.values, m.new or nothing) for m in moves if m.old is not None])

    def commit(self, marks: Mapping[str, str]) -> None:
        self.files.write(self.mark("committed"), json.dumps(dict(marks)))

    def finish(self) -> None:
        """Set the properties, drop emptied partitions, and remove the folders that were replaced and the journal."""
        set_properties(self.spark, self.table, **json.loads(self.files.read(self.mark("committed"))))
        moves = self._moves()
        self._drop([m.values for m in moves if m.new is None])
        for old in (m.old for m in moves if m.old is not None and is_below(m.old, self.kind.location)):
            # With the folders above it, within a version, that hold no partition any more.
            while self.files.exists(old):
                self.files.delete(old)
                above = old.rstrip("/").rpartition("/")[0]
                if is_below(above, _root(self.kind)) and not any("=" in n for n in self.files.names(above)):
                    old = above
        self.files.delete(f"{self.data}/_nothing")
        for state in ("moves", "begun", "committed"):
            self.files.delete(self.mark(state))

    def undo(self) -> None:
        """Give every partition the folder it had, and forget the rows."""
        moves = self._moves()
        self._locate([(m.values, m.old) for m in moves if m.old is not None])
        self._drop([m.values for m in moves if m.old is None])
        self.files.delete(self.data)
        for state in ("moves", "begun"):
            self.files.delete(self.mark(state))

    # -- helpers --------------------------------------------------------------------------------------------------

    def _moves(self) -> list[Move]:
        path = self.mark("moves")
        found = json.loads(self.files.read(path)) if self.files.exists(path) else []
        return [Move(tuple(values), old, new) for values, old, new in found]

    def _save(self, rows: DataFrame, mode: str = "errorifexists") -> None:
        out = rows.write.format(self.kind.provider).options(**self.kind.options).mode(mode)
        out.partitionBy(*self.kind.partition_by).save(self.data)

    def _found(self, folder: str, depth: int) -> list[tuple[Values, str]]:
        """The partitions that have a folder."""
        if not depth:
            return [((), folder)]
        found = []
        for name in self.files.names(folder):
            _, equals, value = name.partition("=")
            if equals:
                text = None if unquote(value) == NULL_VALUE else unquote(value)
                found += [((text, *rest), place) for rest, place in self._found(f"{folder}/{name}", depth - 1)]
        return found

    def _spec(self, values: Values) -> str:
        return spec(self.kind.partition_by, values)

    def located(self, wanted: Iterable[Values]) -> dict[Values, str]:
        """The folders of those of the partitions that the table has."""

        def one(values: Values) -> tuple[Values, str | None]:
            try:
                rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table} PARTITION ({self._spec(values)})").collect()
            except AnalysisException as e:
                if e.getCondition() != "PARTITIONS_NOT_FOUND":
                    raise
                return values, None
            start = next(i for i, r in enumerate(rows) if r.col_name == "# Detailed Partition Information")
            return values, next(r.data_type for r in rows[start:] if r.col_name == "Location")

        return {values: place for values, place in at_once(one, wanted) if place is not None}

    def _add(self, moves: Sequence[Move]) -> None:
        for first in range(0, len(moves), PER_STATEMENT):
            named = [f"PARTITION ({self._spec(m.values)}) LOCATION {quoted(m.new)}" for m in moves[first : first + PER_STATEMENT]]
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {' '.join(named)}")

    def _locate(self, places: Sequence[tuple[Values, str]]) -> None:
        def one(place: tuple[Values, str]) -> None:
            values, folder = place
            self.spark.sql(f"ALTER TABLE {self.table} PARTITION ({self._spec(values)}) SET LOCATION {quoted(folder)}")

        at_once(one, places)

    def _drop(self, listed: Sequence[Values]) -> None:
        for first in range(0, len(listed), PER_STATEMENT):
            named = ", ".join(f"PARTITION ({self._spec(v)})" for v in listed[first : first + PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {named}")


def at_once(work: Callable[[Any], Any], items: Iterable[Any]) -> list[Any]:
    """Catalog statements, a few at a time, as each is a call to the metastore."""
    items = list(items)
    if len(items) < 2:
        return [work(item) for item in items]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(work, items))


def _root(kind: Shape) -> str:
    return f"{kind.location.rstrip('/')}/{PUBLISHED}"


def journal_of(kind: Shape) -> str:
    return f"{_root(kind)}/journal"


def _is(column: str, text: str | None):
    return F.col(f"`{column}`").isNull() if text is None else F.col(f"`{column}`").cast("string") == text


def spec(columns: Sequence[str], values: Values) -> str:
    return ", ".join(f"`{c}` = {'null' if v is None else quoted(v)}" for c, v in zip(columns, values, strict=True))


# -- entry points -------------------------------------------------------------------------------------------------


def write_partitions(
    rows: DataFrame,
    table: str,
    concerned: Iterable[Values] = (),
    marks: Mapping[str, str] | None = None,
    keep_null: bool = False,
) -> list[Values]:
    """Replace the partitions that ``rows`` fall in, and empty those of ``concerned`` that get none; all or nothing.

    The rows may come from the table itself.  With ``keep_null`` partitions with a null value are added to, not replaced.
    ``marks``: properties that are set if the rows are published.  Returns the partitions written.
    """
    spark = rows.sparkSession
    kind = shape(spark, table)
    if kind.provider not in PATH_FORMATS or kind.buckets:
        raise ValueError(f"partitions of {table} ({kind.provider}, {kind.buckets or 'no'} buckets) can't be written by path")
    if not kind.tracked:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    step = Publication(spark, table, kind, uuid.uuid4().hex)
    LIVE.add(step.version)
    try:
        try:
            step.begin()
            written = step.write(rows)
            emptied = [v for v in concerned if v not in written]
            known = step.located([*written, *emptied])
            stays = [v for v in written if None in v and v in known] if keep_null else []
            if stays:
                step.keep(stays)
            step.repoint(step.record(written, emptied, known))
            step.commit(marks or {})
        except Exception:
            step.undo()
            raise
        step.finish()
    finally:
        LIVE.discard(step.version)
        spark.catalog.refreshTable(table)
    return list(written)


def largest_partition(spark: SparkSession, table: str, column: str, within: Column | None = None) -> Any:
    """The greatest value of a partition column, compared by its type, from the catalog: no data file is opened.

    ``within``: a condition on the column, as an upper bound.  Null partitions don't count; None if there is no other.
    """
    if column not in partition_columns(spark, table):
        raise ValueError(f"{table} is not partitioned by {column!r}")
    folder = F.regexp_extract("partition", rf"(?:^|/){re.escape(column)}=([^/]*)", 1)
    text = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    kind = spark.table(table).schema[column].dataType
    values = spark.sql(f"SHOW PARTITIONS {table}").filter(folder != NULL_VALUE).select(text.cast(kind).alias(column))
    values = values if within is None else values.filter(within)
    return values.agg(F.max(F.col(f"`{column}`")).alias("top")).first()["top"]

"""Rewriting only those files of a table without partitions that hold a row to be changed.

The keys of the batch are looked up with the hidden column that tells each row's file, the operator runs over the files found,
and its result takes their place in the table's folder; the other files stay as they are, neither read again nor copied.  New
files are written beside the table and moved in, old ones moved aside, under the same journal as partitions (see
``partitions``): a rewrite that was interrupted is undone by the next load, or finished if it was committed.

While files change places, which takes a few renames, a reader may meet old and new files together.  Loads that must be seen all
at once rewrite the whole table instead (``Load(rewrite="table")``, the default).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.keys import key_list, probably_among
from tidemark.plans.partitions import LIVE, Publication, at_once
from tidemark.plans.publish import PATH_FORMATS, set_properties, shape

#: Files that are rewritten one by one; beyond that the whole table is rewritten.
MAX_FILES = 5_000


class FileSwap(Publication):
    """One change of a table's files."""

    @property
    def aside(self) -> str:
        return f"{self.data}/_old"

    def place(self, name: str) -> str:
        return f"{self.kind.location.rstrip('/')}/{name}"

    def write(self, rows: DataFrame) -> list[str]:
        """Write the rows and tell the names of their files."""
        types = [(f.name, f.dataType) for f in self.spark.table(self.table).schema.fields]
        typed = rows.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types])
        typed.write.format(self.kind.provider).options(**self.kind.options).save(self.data)
        return [n for n in self.files.names(self.data) if not n.startswith(("_", "."))]

    def record(self, old: Sequence[str], new: Sequence[str]) -> tuple[list[str], list[str]]:
        moves = (list(old), list(new))
        self.files.write(self.mark("moves"), json.dumps(moves))
        return moves

    def repoint(self, moves: tuple[list[str], list[str]]) -> None:
        """New files into the table's folder, old ones out of it."""
        old, new = moves
        self.files.make(self.aside)
        at_once(lambda n: self.files.move(f"{self.data}/{n}", self.place(n)), new)
        at_once(lambda n: self.files.move(self.place(n), f"{self.aside}/{n}"), old)

    def finish(self) -> None:
        set_properties(self.spark, self.table, **json.loads(self.files.read(self.mark("committed"))))
        self.files.delete(self.data)
        for state in ("moves", "begun", "committed"):
            self.files.delete(self.mark(state))

    def undo(self) -> None:
        old, new = json.loads(self.files.read(self.mark("moves"))) if self.files.exists(self.mark("moves")) else ([], [])
        back = [n for n in old if self.files.exists(f"{self.aside}/{n}")]
        at_once(lambda n: self.files.move(f"{self.aside}/{n}", self.place(n)), back)
        at_once(lambda n: self.files.delete(self.place(n)), new)
        self.files.delete(self.data)
        for state in ("moves", "begun"):
            self.files.delete(self.mark(state))


def files_holding(rows: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The files (file) of those ``rows``, of a table, whose key is one of the batch's; only the key columns are read."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    keys = batch.select(*[F.col(f"`{k}`").cast(kinds[k]).alias(k) for k in key])
    placed = rows.select(*[f"`{k}`" for k in key], F.col("_metadata.file_path").alias("_file"))
    # The filter leaves few rows, so that the table is not shuffled for the exact join.
    return probably_among(placed, keys, key).join(key_list(keys, key), list(key), "left_semi").select("_file").distinct()


def rewrite_files(
    batch: DataFrame,
    table: str,
    operator: Callable[[DataFrame, DataFrame], DataFrame],
    touched: DataFrame,
    marks: Mapping[str, str] | None = None,
) -> bool:
    """Put ``operator(rows of the touched files, batch)`` in the place of these files; False if that can't be done.

    It can't for tables with partitions or buckets, in other formats, with files in deeper folders, or when more than
    ``MAX_FILES`` are touched.
    """
    spark = batch.sparkSession
    kind = shape(spark, table)
    if kind.provider not in PATH_FORMATS or kind.buckets or kind.partition_by:
        return False
    found = touched.limit(MAX_FILES + 1).collect()  # names of files, at most the bound
    paths = [unquote(row[0]) for row in found]
    names = [path.rpartition("/")[2] for path in paths]
    step = FileSwap(spark, table, kind, uuid.uuid4().hex)
    if len(paths) > MAX_FILES or not all(step.files.exists(step.place(n)) for n in names):
        return False
    target = spark.table(table)
    scope = target.limit(0)
    if names:
        reader = spark.read.schema(target.schema).format(kind.provider).options(**kind.options)
        scope = reader.load([step.place(n) for n in names])
    LIVE.add(step.version)
    try:
        try:
            step.begin()
            new = step.write(operator(scope, batch))
            step.repoint(step.record(names, new))
            step.commit(marks or {})
        except Exception:
            step.undo()
            raise
        step.finish()
    finally:
        LIVE.discard(step.version)
        spark.catalog.refreshTable(table)
    return True

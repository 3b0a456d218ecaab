"""Keeping type-2 history tables.

The table is partitioned by the run that closed a version (``closed_in``; open versions carry 'open').  A run rewrites
the open partition and adds one partition with what it closed, so its cost follows the open versions, never the whole
history.  A run with the clock of an earlier one keeps what that one closed.  Both partitions are published together: a run that
was interrupted has changed neither, and may be repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import clock
from tidemark.operators import history as hist
from tidemark.plans.partitions import write_partitions
from tidemark.plans.publish import has_partition, is_view, replace_table, table_exists
from tidemark.plans.recovery import recover
from tidemark.session import cleaned_up, stage

CLOSED_IN = "closed_in"
OPEN = "open"


def _labelled(rows: DataFrame, cfg: hist.Snapshot, label: str) -> DataFrame:
    return rows.withColumn(CLOSED_IN, F.when(hist.is_open(cfg), OPEN).otherwise(label))


def take_snapshot(
    source: DataFrame, table: str, cfg: hist.Snapshot, now: dt.datetime | None = None, location: str | None = None
) -> None:
    """Bring a history table up to date with its source."""
    now = clock(now)
    label = now.strftime("%Y%m%dT%H%M%S%f")
    spark = source.sparkSession
    if not table_exists(spark, table):
        replace_table(
            _labelled(hist.first_build(source, cfg, now), cfg, label),
            table,
            partition_by=[CLOSED_IN],
            location=location,
        )
        return
    if is_view(spark, table):
        raise ValueError(f"{table} is a view, not a history table")
    recover(spark, table)
    with cleaned_up(spark):
        history = spark.table(table)
        moved = hist.advance(
            history.filter(F.col(CLOSED_IN) == OPEN).drop(CLOSED_IN),
            source,
            cfg,
            now,
            closed=history.filter(F.col(CLOSED_IN) != OPEN),
        )
        _write(moved, table, cfg, label)


def _write(
    moved: DataFrame, table: str, cfg: hist.Snapshot, label: str, marks: Mapping[str, str] | None = None
) -> None:
    """Replace the open partition, and put the versions closed now into the run's own partition."""
    spark = moved.sparkSession
    known = set(spark.table(table).columns)
    added = [f for f in moved.schema.fields if f.name not in known]
    if added:
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({declared})")
    rows = _labelled(moved, cfg, label)
    if has_partition(spark, table, **{CLOSED_IN: label}):
        # An earlier run had the same clock: its versions stay, but for those that are closed again.
        rows = stage(rows, "moved").frame
        earlier = spark.table(table).filter(F.col(CLOSED_IN) == label)
        again = rows.filter(F.col(CLOSED_IN) == label).select(cfg.meta.scd_id)
        rows = rows.unionByName(earlier.join(again, cfg.meta.scd_id, "left_anti").select(rows.columns))
    write_partitions(rows, table, marks=marks)


def append_changes(
    changes: DataFrame,
    table: str,
    cfg: hist.Snapshot,
    now: dt.datetime | None = None,
    location: str | None = None,
    marks: Mapping[str, str] | None = None,
    deleted: str | None = None,
) -> None:
    """Add a set of changes, several to a key, to a history table (see ``history.advance_by_changes``).

    ``marks``: properties that are set along with the rows.  ``deleted``: the boolean column that marks deletions.
    """
    now = clock(now)
    label = now.strftime("%Y%m%dT%H%M%S%f")
    spark = changes.sparkSession
    with cleaned_up(spark):
        if not table_exists(spark, table):
            rows = changes if deleted is None else changes.drop(deleted)
            empty = hist.first_build(rows.limit(0), cfg, now)
            replace_table(_labelled(empty, cfg, label), table, partition_by=[CLOSED_IN], location=location)
        recover(spark, table)
        history = spark.table(table)
        current = history.filter(F.col(CLOSED_IN) == OPEN).drop(CLOSED_IN)
        _write(hist.advance_by_changes(current, changes, cfg, now, deleted), table, cfg, label, marks)


def read_history(spark: SparkSession, table: str) -> DataFrame:
    """All versions, without the layout column."""
    return spark.table(table).drop(CLOSED_IN)

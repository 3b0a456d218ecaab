"""Incremental loading: what a target holds after a batch has been loaded into it.

Every operator is a pure function from DataFrames to a DataFrame; ``tidemark.plans.load`` applies them to tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import as_time, date_trunc
from tidemark.functions.types import literal
from tidemark.operators.keys import all_of, as_condition, distinct_keys, is_true, key_list, normalise_key
from tidemark.operators.merge import merge

#: Above this many, partitions are joined instead of listed as literals.
MAX_LISTED_PARTITIONS = 5_000

#: Batch sizes of event-time microbatches.
BATCH_SIZES = ("hour", "day", "month", "year")


def newer_than_target(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Source rows above the target's high-water mark; the whole source when there is no target yet.

    The mark is read first and enters the filter as a literal, so it prunes partitions and row groups of the source.
    """
    if target is None:
        return source
    mark = target.agg(F.max(column).alias("mark")).first()["mark"]
    if mark is None:
        return source.limit(0)
    return source.filter(F.col(column) > literal(mark, source.schema[column].dataType))


def max_partition(target: DataFrame, column: str) -> Any:
    """The greatest non-null partition value, as a literal for pruning; None for an empty target."""
    return target.filter(F.col(column).isNotNull()).agg(F.max(column).alias("top")).first()["top"]


def _aligned(batch: DataFrame, target: DataFrame) -> DataFrame:
    return batch.select(*[F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) for c in target.columns])


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both; the target's columns, matched by name."""
    return target.unionByName(_aligned(batch, target))


def delete_insert(
    target: DataFrame,
    batch: DataFrame,
    key: str | Sequence[str] | None,
    predicates: Column | str | Sequence[Column | str] | None = None,
) -> DataFrame:
    """Delete target rows whose key occurs in the batch and that meet all predicates, then insert the whole batch.

    Repeated batch rows stay repeated, and target rows outside the predicates stay beside their batch row.  One anti
    join reads the target once, against a list of the batch's keys.
    """
    key = normalise_key(key, target, batch)
    rows = _aligned(batch, target)
    if not key:
        return target.unionByName(rows)
    keys = key_list(rows, key).toDF(*[f"_key_{k}" for k in key])
    hit = all_of([F.col(f"target.`{k}`") == F.col(f"`_key_{k}`") for k in key])
    predicate = as_condition(predicates)
    if predicate is not None:
        hit = hit & predicate
    kept = target.alias("target").join(keys, hit, "left_anti")
    return kept.unionByName(rows)


def overwrite_all(target: DataFrame, batch: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The batch replaces everything; with ``columns`` the other columns are null."""
    chosen = set(columns or target.columns)
    return batch.select(
        *[
            (F.col(f"`{c}`") if c in chosen else F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )


def partitions_touched(batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The distinct partitions a batch writes to; partitions with a null part do not count."""
    return distinct_keys(batch, partition_by)


def overwrite_partitions(
    target: DataFrame, batch: DataFrame, partition_by: Sequence[str], grain: str | None = None
) -> DataFrame:
    """Replace the partitions present in the batch and keep the others.

    ``grain`` truncates a single date partition column first, so a batch replaces whole months, for example.

    The touched partitions are listed first.  Up to ``MAX_LISTED_PARTITIONS`` they become literals, so the target is
    neither shuffled nor, if it is partitioned, read where it is replaced; more of them are joined.
    """
    rows = _aligned(batch, target)
    parts = [F.col(f"`{c}`") for c in partition_by]
    if grain is not None:
        (column,) = parts
        parts = [date_trunc(grain, column)]
    names = [f"_part{i}" for i in range(len(parts))]
    touched = distinct_keys(rows.select(*[part.alias(n) for part, n in zip(parts, names)]), names)
    listed = touched.limit(MAX_LISTED_PARTITIONS + 1).collect()  # partition values, at most the bound
    if len(listed) > MAX_LISTED_PARTITIONS:
        same = all_of([part == F.col(n) for part, n in zip(parts, names)])
        spread = key_list(rows.select(*[part.alias(n) for part, n in zip(parts, names)]), names)
        return target.join(spread, same, "left_anti").unionByName(rows)
    if len(parts) == 1:
        kind = touched.schema[names[0]].dataType
        replaced = parts[0].isin(*[literal(row[0], kind) for row in listed]) if listed else F.lit(False)
        return target.filter(~is_true(replaced)).unionByName(rows)
    known = target.sparkSession.createDataFrame(listed, touched.schema)  # a local relation: broadcast by its size
    same = all_of([part == F.col(n) for part, n in zip(parts, names)])
    return target.join(known, same, "left_anti").unionByName(rows)


def overwrite_listed(target: DataFrame, batch: DataFrame, partition_by: str, values: Sequence[Any]) -> DataFrame:
    """Clear the listed partitions, even those the batch has no rows for, then insert the whole batch."""
    data_type = target.schema[partition_by].dataType
    listed = F.col(partition_by).isin(*[literal(v, data_type) for v in values])
    return target.filter(~is_true(listed)).unionByName(_aligned(batch, target))


# -- event-time microbatches ------------------------------------------------------------------------------------


def in_window(column: str, start: dt.datetime | None, end: dt.datetime | None) -> Column:
    """Half-open event-time window; a missing bound does not restrict."""
    condition = F.lit(True)
    if start is not None:
        condition = F.col(column) >= as_time(start)
    if end is not None:
        before = F.col(column) < as_time(end)
        condition = before if start is None else condition & before
    return condition


def _floor(moment: dt.datetime, size: str) -> dt.datetime:
    floored = moment.replace(minute=0, second=0, microsecond=0)
    if size != "hour":
        floored = floored.replace(hour=0)
    if size in ("month", "year"):
        floored = floored.replace(day=1)
    return floored.replace(month=1) if size == "year" else floored


def _next(moment: dt.datetime, size: str) -> dt.datetime:
    if size == "hour":
        return moment + dt.timedelta(hours=1)
    if size == "day":
        return moment + dt.timedelta(days=1)
    if size == "month":
        return _floor(moment + dt.timedelta(days=32), "month")
    return moment.replace(year=moment.year + 1)


def batch_windows(begin: dt.datetime, end: dt.datetime, size: str) -> Iterator[tuple[dt.datetime, dt.datetime]]:
    """Consecutive half-open windows of one batch size covering ``[begin, end)``."""
    if size not in BATCH_SIZES:
        raise ValueError(f"batch size must be one of {BATCH_SIZES}, not {size!r}")
    start = _floor(begin, size)
    while start < end:
        yield start, _next(start, size)
        start = _next(start, size)


def microbatch_delete_insert(
    target: DataFrame, batch: DataFrame, event_time: str, start: dt.datetime, end: dt.datetime
) -> DataFrame:
    """Replace the target's rows of one event-time window by the batch's; rows without an event time stay."""
    if start is None or end is None:
        raise ValueError("a microbatch needs both window bounds")
    window = in_window(event_time, start, end)
    return target.filter(~is_true(window)).unionByName(_aligned(batch.filter(window), target))


def microbatch_overwrite(
    target: DataFrame, batch: DataFrame, event_time: str, size: str, start: dt.datetime, end: dt.datetime
) -> DataFrame:
    """Overwrite the partitions of one batch size that the rows of the whole windows between start and end fall in."""
    windows = list(batch_windows(start, end, size))
    if not windows:
        return target
    inside = in_window(event_time, windows[0][0], windows[-1][1])
    return overwrite_partitions(target, batch.filter(inside), [event_time], grain=size)


def microbatch_merge(
    target: DataFrame,
    batch: DataFrame,
    key: str | Sequence[str],
    event_time: str,
    start: dt.datetime,
    end: dt.datetime,
) -> DataFrame:
    """Upsert one window's rows by key."""
    if not normalise_key(key, target, batch):
        raise ValueError("microbatches by merge need a unique key")
    return merge(target, batch.filter(in_window(event_time, start, end)), key)

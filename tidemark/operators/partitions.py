"""Derived partition columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import date_trunc
from tidemark.operators.compare import union_all

GRAINS = ("hour", "day", "month", "year")


def time_partition(column: str, grain: str = "day") -> Column:
    """The hour, day, month or year a row belongs to."""
    if grain not in GRAINS:
        raise ValueError(f"partition by one of {GRAINS}, not {grain!r}")
    return date_trunc(grain, F.col(column))


def range_bucket(column: str, start: int, interval: int) -> Column:
    """Lower bound of the integer range a row falls in."""
    value = F.col(column)
    return value - F.pmod(value - F.lit(start), F.lit(interval))


def hash_bucket(columns: Sequence[str] | str, buckets: int) -> Column:
    """A bucket number in ``[0, buckets)``, computed as Spark does for bucketed tables."""
    names = [columns] if isinstance(columns, str) else list(columns)
    return F.pmod(F.hash(*names), F.lit(buckets))


def ingestion_partition(df: DataFrame, field: str, grain: str = "day", name: str = "_partition_time") -> DataFrame:
    """Partition time taken from a field that is then dropped from the payload."""
    return df.withColumn(name, time_partition(field, grain)).drop(field)


COPY_MODES = {"table": "overwrite", "incremental": "append"}


def copy_sources(*sources: DataFrame, mode: str = "table") -> tuple[DataFrame, str]:
    """Rows of several sources for one target, with the write mode they need."""
    if mode not in COPY_MODES:
        raise ValueError(f"copy mode must be one of {sorted(COPY_MODES)}, not {mode!r}")
    return union_all(*sources), COPY_MODES[mode]

"""How recent the data of a source is."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import as_time, as_utc
from tidemark.operators.keys import as_condition

#: What an empty source counts as: loaded infinitely long ago.
NEVER = dt.datetime(1, 1, 1)


def _verdict(latest: DataFrame, now: dt.datetime) -> DataFrame:
    """Instants (TIMESTAMP) and ``now`` are in UTC, so no age depends on the session's time zone."""
    found = as_utc(F.col("max_loaded_at"), latest.schema["max_loaded_at"].dataType)
    loaded = F.coalesce(found, as_time(NEVER))
    moment = as_time(now)
    age = F.timestamp_diff("MICROSECOND", loaded, moment) / F.lit(1_000_000.0)
    return latest.select(loaded.alias("max_loaded_at"), moment.alias("snapshotted_at"), age.alias("age"))


def by_field(df: DataFrame, loaded_at: str, now: dt.datetime, where: Column | str | None = None) -> DataFrame:
    """One row (max_loaded_at, snapshotted_at, age in seconds)."""
    condition = as_condition(where)
    rows = df if condition is None else df.filter(condition)
    return _verdict(rows.agg(F.max(F.col(loaded_at)).alias("max_loaded_at")), now)


def by_query(result: DataFrame, now: dt.datetime) -> DataFrame:
    """The same from a query that yields the load time as its only value."""
    if len(result.columns) != 1:
        raise ValueError(f"a freshness query yields one column, not {result.columns}")
    return _verdict(result.toDF("max_loaded_at"), now)


def by_files(spark: SparkSession, path: str, now: dt.datetime, pattern: str | None = None) -> DataFrame:
    """The same from the files' modification times; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        files = files.option("pathGlobFilter", pattern)
    times = files.load(path).select(F.col("modificationTime"))
    return _verdict(times.agg(F.max("modificationTime").alias("max_loaded_at")), now)


def many(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Several verdicts in one frame, each labelled by its source."""
    if not sources:
        raise ValueError("no sources given")
    parts = [verdict.select(F.lit(name).alias("source"), *verdict.columns) for name, verdict in sources.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result

"""Reading relations: named or by path, limited, and filtered by event time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.incremental import in_window


def relation(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view, or a path to files (anything containing '/')."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def scan(
    df: DataFrame,
    limit: int | None = None,
    event_time: str | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """A restricted look at a relation: the limit applies first, the half-open event window to what it left.

    ``limit=0`` gives the schema without rows.  Without a limit the window reaches the file scan.
    """
    rows = df if limit is None else df.limit(limit)
    if event_time is None or (start is None and end is None):
        return rows
    return rows.filter(in_window(event_time, start, end))


def preview(df: DataFrame, limit: int = 5) -> DataFrame:
    """A few rows to look at; a negative limit means all."""
    return df if limit < 0 else df.limit(limit)

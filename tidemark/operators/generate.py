"""Generated rows: number series, date spines and date lists.  All are split over the cluster by ``spark.range``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import as_time, boundaries_between, date_trunc, dateadd


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """1, 2, …, ``upper`` in the column generated_number."""
    if upper <= 0:
        raise ValueError("the upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def intervals_between(part: str, start: dt.datetime, end: dt.datetime) -> int:
    """Boundaries crossed from start to end."""
    return boundaries_between(start, end, part)


def date_spine(spark: SparkSession, part: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """start, start + 1 part, … before ``end``, in the column ``date_<part>``."""
    count = intervals_between(part, start, end)
    if count <= 0:
        raise ValueError(f"no {part} boundary between {start} and {end}")
    first, last = (as_time(moment) for moment in (start, end))
    point = dateadd(part, F.col("id").cast("int"), first)
    return spark.range(count).select(point.alias(f"date_{part}")).filter(F.col(f"date_{part}") <= last)


def fill_gaps(spine: DataFrame, facts: DataFrame, part: str, moment: str, measures: dict[str, Column]) -> DataFrame:
    """Measures per spine point, points without facts included.

    Facts are aggregated to the spine's grain before the join, so a busy day costs one row per input partition.
    """
    point = f"date_{part}"
    grouped = facts.groupBy(date_trunc(part, F.col(moment)).alias(point)).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    return spine.join(grouped, point, "left")


def _parse(text: str, pattern: str) -> dt.date:
    return dt.datetime.strptime(text.strip(), pattern).date()


def dates_in_range(
    spark: SparkSession,
    start: str,
    end: str | None = None,
    in_format: str = "%Y%m%d",
    out_format: str = "yyyyMMdd",
) -> DataFrame:
    """Every date from start to end, both included, as text in the column date_text."""
    first = _parse(start, in_format)
    last = _parse(end, in_format) if end is not None else first
    if first > last:
        raise ValueError(f"the start {start} lies after the end {end}")
    days = spark.range((last - first).days + 1)
    return days.select(F.date_format(F.date_add(F.lit(first), F.col("id").cast("int")), out_format).alias("date_text"))


def partition_range(spark: SparkSession, text: str, in_format: str = "%Y%m%d") -> DataFrame:
    """Dates of a range written 'first' or 'first,last'."""
    bounds = text.split(",")
    if len(bounds) > 2:
        raise ValueError(f"a range has one or two dates, not {len(bounds)}")
    return dates_in_range(spark, bounds[0], bounds[1] if len(bounds) == 2 else None, in_format=in_format)

"""Set operations and comparison of relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks."""
    return a.subtract(b)


def intersect_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows both have."""
    return a.intersect(b)


def union_all(*frames: DataFrame, fill_missing: bool = False) -> DataFrame:
    """All rows, columns matched by name."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=fill_missing), frames)


def _side_counts(a: DataFrame, b: DataFrame) -> tuple[DataFrame, list[str]]:
    """Each distinct row with its number of copies on either side: one aggregation instead of two EXCEPTs."""
    columns = sorted(a.columns)
    if columns != sorted(b.columns):
        raise ValueError(f"the relations have different columns: {columns} and {sorted(b.columns)}")
    left = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    counts = left.unionByName(right).groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return counts, columns


def _total(expr: Column) -> Column:
    return F.coalesce(F.sum(expr), F.lit(0)).cast("bigint")


def rel_diff(a: DataFrame, b: DataFrame, multiset: bool = False) -> DataFrame:
    """(row_count_difference, num_mismatched) of two relations.

    Mismatched are the distinct rows only one side has; with ``multiset`` every surplus copy counts.
    """
    counts, _ = _side_counts(a, b)
    if multiset:
        mismatched = F.abs(F.col("_a") - F.col("_b"))
    else:
        mismatched = F.when((F.col("_a") > 0) != (F.col("_b") > 0), 1).otherwise(0)
    return counts.agg(
        _total(F.col("_a") - F.col("_b")).alias("row_count_difference"), _total(mismatched).alias("num_mismatched")
    )


def row_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The differing rows themselves: (columns…, side, copies), side being 'expected' or 'actual'.

    The comparison of a unit test: empty iff both hold the same rows equally often.
    """
    counts, columns = _side_counts(expected, actual)
    surplus = F.col("_a") - F.col("_b")
    return counts.filter(surplus != 0).select(
        *columns, F.when(surplus > 0, "expected").otherwise("actual").alias("side"), F.abs(surplus).alias("copies")
    )


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether both hold the same rows equally often."""
    return row_diff(a, b.select(*a.columns)).isEmpty()

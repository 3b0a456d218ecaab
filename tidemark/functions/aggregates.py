"""Aggregates, including ordered string aggregation that survives hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def any_value(expr: Column, deterministic: bool = False) -> Column:
    """Some value of the group; ``deterministic`` picks the smallest."""
    return F.min(expr) if deterministic else F.any_value(expr)


def bool_or(expr: Column) -> Column:
    """True if any value is true; nulls are ignored."""
    return F.bool_or(expr)


def sum_positive(expr: Column) -> Column:
    """Sum of the values above zero; 0 when there are none."""
    return F.coalesce(F.sum(F.when(expr > 0, expr)), F.sum(F.lit(0)))


def sum_squared(expr: Column) -> Column:
    """Square of the sum."""
    return F.pow(F.sum(expr), F.lit(2))


def listagg(
    df: DataFrame,
    by: Sequence[str],
    measure: Column,
    delimiter: str = ",",
    order_by: Column | None = None,
    limit: int | None = None,
    distinct: bool = False,
    alias: str = "listagg",
) -> DataFrame:
    """Join the texts of every group, in order, with an optional limit per group.

    Nulls are skipped; without ``order_by`` the texts are sorted by themselves, so results are reproducible.

    * ``distinct`` removes duplicates by an aggregation first, which combines before the shuffle.
    * ``limit`` keeps the first rows per group by a ranked filter, which Spark also applies before the shuffle, so a
      hot group sends at most ``limit`` rows per input partition.
    * The unlimited form range-partitions on (group, order), so a group holding much of the data is spread over many
      tasks, each joining its own stretch; only the joined stretches meet in one place.  The final text of a group
      is one value and must fit Spark's limit for a single value.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    keys = list(by)
    rows = df.select(*keys, (measure if order_by is None else order_by).alias("_o"), measure.cast("string").alias("_m"))
    rows = rows.filter(F.col("_m").isNotNull())
    if distinct:
        rows = rows.groupBy(*keys, "_m").agg(F.min("_o").alias("_o"))

    if limit is not None:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_o").asc_nulls_last(), "_m"))
        top = rows.withColumn("_n", place).filter(F.col("_n") <= limit)
        first = F.array_sort(F.collect_list(F.struct("_n", "_m")))
        return top.groupBy(*keys).agg(
            F.array_join(F.transform(first, lambda entry: entry["_m"]), delimiter).alias(alias)
        )

    # The range split must be able to fall between any two rows, so rows equal in group, order and text are carried as
    # one with a count.  (A row number would break such ties too, but not the same way when a lost task runs again.)
    if distinct:
        rows = rows.withColumn("_c", F.lit(1))
    else:
        rows = rows.groupBy(*keys, "_o", "_m").agg(F.count(F.lit(1)).cast("int").alias("_c"))
    in_order = F.array_sort(F.collect_list(F.struct(F.col("_o").isNull().alias("_z"), "_o", "_m", "_c")))
    in_order = F.flatten(F.transform(in_order, lambda entry: F.array_repeat(entry["_m"], entry["_c"])))
    stretch = (
        rows.repartitionByRange(*keys, F.col("_o").asc_nulls_last(), "_m")
        .withColumn("_p", F.spark_partition_id())
        .groupBy(*keys, "_p")
        .agg(F.array_join(in_order, delimiter).alias("_t"))
    )
    pieces = F.array_sort(F.collect_list(F.struct("_p", "_t")))
    return stretch.groupBy(*keys).agg(
        F.array_join(F.transform(pieces, lambda piece: piece["_t"]), delimiter).alias(alias)
    )

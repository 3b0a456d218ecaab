"""Newest row per key, and newest shard per table family."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark turns the ranked filter into a limit per key that also runs before the shuffle, so a hot key sends at most
    one row per input partition.
    """
    ranked = df.withColumn("_place", F.row_number().over(Window.partitionBy(*key).orderBy(*order_by)))
    return ranked.filter(F.col("_place") == 1).drop("_place")


def _shard(column: str, part: int) -> Column:
    return F.regexp_extract(column, r"^(.*[^0-9])([0-9]{8})$", part)


def shard_family(column: str = "name") -> Column:
    """The family of a table named ``<prefix><yyyymmdd>``: its prefix; names without a date are families of their own."""
    return F.when(_shard(column, 2) != "", _shard(column, 1)).otherwise(F.col(column))


def latest_shards(names: DataFrame, column: str = "name") -> DataFrame:
    """Of tables named ``<prefix><yyyymmdd>``, per prefix the newest and the oldest, and the number of shards."""
    return (
        names.select(shard_family(column).alias("family"), F.col(column).alias("name"))
        .groupBy("family")
        .agg(F.max("name").alias("latest"), F.min("name").alias("oldest"), F.count(F.lit(1)).alias("shards"))
    )


def union_shards(shards: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of all shards of one family, each with its shard's date text; columns that a shard lacks are null."""
    if not shards:
        raise ValueError("no shards given")
    frames = [df.withColumn("shard", F.lit(name[-8:])) for name, df in sorted(shards.items())]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result

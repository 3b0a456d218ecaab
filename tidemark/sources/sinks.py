"""Writing tables: formats, partitions, buckets and physical order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameWriter, functions as F, types as T

from tidemark.functions.types import literal

#: Formats a table may be written in; some need their package on the cluster.
FORMATS = ("text", "csv", "json", "jdbc", "parquet", "orc", "hive", "delta", "iceberg", "libsvm", "hudi")


def validate_format(file_format: str) -> str:
    if file_format not in FORMATS:
        raise ValueError(f"file format must be one of {', '.join(FORMATS)}, not {file_format!r}")
    return file_format


def gathered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows of one partition value brought together, so each value is written to few files.

    A rebalance, not a repartition: adaptive execution splits a value that holds much of the data over several tasks
    and joins small ones.
    """
    names = [F.col(f"`{c}`") for c in columns]
    return df.hint("rebalance", files, *names) if files else df.hint("rebalance", *names)


def writer(
    df: DataFrame,
    file_format: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
    location: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrameWriter:
    """A configured writer.  Rows are gathered by partition, or by bucket, so the number of files stays small."""
    validate_format(file_format)
    if bool(bucket_by) != bool(buckets):
        raise ValueError("buckets need both columns and a number")
    rows = df
    if bucket_by and not partition_by:
        # As many parts as buckets, hashed alike: each task writes one bucket.
        rows = gathered(df, bucket_by, buckets)
    elif partition_by:
        rows = gathered(df, partition_by)
    out = rows.write.format(file_format).mode(mode).options(**(options or {}))
    if partition_by:
        out = out.partitionBy(*partition_by)
    if bucket_by:
        out = out.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    return out.option("path", location) if location else out


def write_table(df: DataFrame, table: str, **settings) -> None:
    """Write a catalog table (see ``writer``)."""
    writer(df, **settings).saveAsTable(table)


def write_files(df: DataFrame, path: str, **settings) -> None:
    """Write files at a path (see ``writer``)."""
    writer(df, **settings).save(path)


def sorted_layout(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows in key order across and within files, so scans on the keys skip most files.

    A hash of the row breaks ties in the range split, so even one key holding much of the data spreads over files.
    """
    names = [F.col(f"`{k}`") for k in keys]
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() != "map"]
    bounds = [*names, F.xxhash64(*hashable)]
    ranged = df.repartitionByRange(parts, *bounds) if parts else df.repartitionByRange(*bounds)
    return ranged.sortWithinPartitions(*names)


def interleaved_layout(df: DataFrame, keys: Sequence[str], levels: int = 8, parts: int | None = None) -> DataFrame:
    """Rows clustered by several keys with equal weight: scans on any one of them skip files.

    Each key is cut into ``2**levels`` equal ranges at approximate quantiles, and the bits of the range numbers are
    interleaved into one sort key.  Keys are numbers, dates or timestamps.
    """
    steps = 2**levels
    points = [i / steps for i in range(1, steps)]
    cuts = df.agg(*[F.percentile_approx(F.col(f"`{k}`"), points).alias(f"q{i}") for i, k in enumerate(keys)]).first()

    def rank(key: str, bounds: Sequence) -> Column:
        """Number of cuts below the value."""
        data_type = df.schema[key].dataType
        listed = F.array(*[literal(v, data_type) for v in bounds]).cast(T.ArrayType(data_type))
        return F.size(F.filter(listed, lambda bound: bound < F.col(f"`{key}`"))).cast("bigint")

    bits = F.lit(0).cast("bigint")
    ranks = [rank(key, cuts[f"q{i}"] or []) for i, key in enumerate(keys)]
    for level in range(levels):
        for i, place in enumerate(ranks):
            bit = F.shiftright(place, level).bitwiseAND(F.lit(1).cast("bigint"))
            bits = bits.bitwiseOR(F.shiftleft(bit, level * len(keys) + i))
    return sorted_layout(df.withColumn("_order", bits), ["_order"], parts).drop("_order")


def file_ranges(written: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(file, n, lo_<column>, hi_<column>): rows and value ranges of the files a frame reads.

    ``written`` is a plain read of files.  Only the columns are read, and a file gives a row for each task that reads it.
    """
    bounds = [
        bound(F.col(f"`{c}`")).alias(f"{side}_{c}") for c in columns for side, bound in (("lo", F.min), ("hi", F.max))
    ]
    named = written.select(F.col("_metadata.file_path").alias("file"), *[F.col(f"`{c}`") for c in columns])
    return named.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *bounds)


def files_read(ranges: DataFrame, column: str, low: Any, high: Any) -> int:
    """How many of the files (see ``file_ranges``) a scan with ``low <= column < high`` can't skip by their statistics."""
    lowest, highest = F.col(f"`lo_{column}`"), F.col(f"`hi_{column}`")
    kind = ranges.schema[f"lo_{column}"].dataType
    return ranges.filter((highest >= literal(low, kind)) & (lowest < literal(high, kind))).count()


def distributed(df: DataFrame, style: str, key: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Rows spread by key, or evenly.

    ('all', a copy on every node, is not offered as a layout: the optimiser broadcasts by measured size.)
    """
    if style == "key":
        return gathered(df, key, parts)
    if style == "even":
        return df.hint("rebalance", parts) if parts else df.hint("rebalance")
    raise ValueError(f"distribution must be 'key' or 'even', not {style!r}")

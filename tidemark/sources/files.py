"""Loading files: seeds with inferred types, and bulk loads."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.keys import resolve

#: Shapes of date and timestamp texts.
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{1,2}:\d{2}"


def _fits(text: Column) -> dict[str, Column]:
    """Per type, whether a text is one of its values."""
    return {
        "bigint": text.rlike(r"^[+-]?\d+$") & text.try_cast("bigint").isNotNull(),
        "double": text.try_cast("double").isNotNull() & ~text.rlike(r"(?i)^[+-]?(nan|inf|infinity)$|[dDfF]$"),
        "boolean": F.lower(text).isin("true", "false"),
        "date": text.rlike(_DATE) & text.try_cast("date").isNotNull(),
        "timestamp_ntz": (text.rlike(_TIME) | text.rlike(_DATE)) & text.try_cast("timestamp_ntz").isNotNull(),
    }


def infer_types(df: DataFrame) -> dict[str, T.DataType]:
    """The narrowest type every text of each column fits: integer, double, boolean, date, timestamp, else string.

    One aggregation over the whole file decides all columns.  A column of clock times, or without any value, is text.
    """
    checks = []
    for i, name in enumerate(df.columns):
        text = F.trim(F.col(f"`{name}`"))
        checks.append(F.count(text).alias(f"n{i}"))
        checks += [F.bool_and(F.when(text.isNotNull(), fit)).alias(f"{kind}{i}") for kind, fit in _fits(text).items()]
    verdict = df.agg(*checks).first()  # one row, one flag per column and type
    kinds = list(_fits(F.lit("")))
    types = {}
    for i, name in enumerate(df.columns):
        chosen = next((k for k in kinds if verdict[f"n{i}"] and verdict[f"{k}{i}"]), "string")
        types[name] = T._parse_datatype_string(chosen)
    return types


def read_seed(
    spark: SparkSession,
    path: str,
    delimiter: str = ",",
    column_types: Mapping[str, str] | None = None,
    quote: str = '"',
    infer: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV file with a header as a typed frame; ``column_types`` overrides single columns.

    Set ``multi_line`` only for files with line breaks inside quotes: such a file cannot be split between tasks.
    """
    options = {"header": True, "sep": delimiter, "quote": quote, "escape": quote, "multiLine": multi_line}
    texts = spark.read.options(**options).option("inferSchema", False).csv(path)
    texts = texts.toDF(*[c.lstrip("﻿") for c in texts.columns])
    types: dict[str, Any] = infer_types(texts) if infer else {c: T.StringType() for c in texts.columns}
    for name, wanted in (column_types or {}).items():
        types[resolve(texts, name)] = T._parse_datatype_string(wanted)
    columns = []
    for name in texts.columns:
        text, wanted = F.col(f"`{name}`"), types[name]
        columns.append((text if isinstance(wanted, T.StringType) else F.trim(text).cast(wanted)).alias(name))
    return texts.select(*columns)


def load_files(
    spark: SparkSession, path: str, file_format: str, schema: T.StructType | str | None = None, **options: Any
) -> DataFrame:
    """Files of any supported format as a frame (CSV, NDJSON, Parquet, ORC, text)."""
    reader = spark.read.format(file_format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)

"""Named example queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def demo(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(query: Query) -> Query:
        name = query.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def fresh_name(label: str) -> str:
    """A table name no other run uses."""
    return f"{label}_{uuid.uuid4().hex[:12]}"

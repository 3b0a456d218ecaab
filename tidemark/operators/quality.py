"""Data tests and unit tests.

A test is a DataFrame of failing rows; ``evaluate`` turns it into one row with the verdict.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.compare import row_diff
from tidemark.operators.keys import as_condition, is_true, key_list

STORE_AS = ("ephemeral", "table", "view")


def tested(df: DataFrame, where: Column | str | None = None) -> DataFrame:
    """The rows a test looks at."""
    condition = as_condition(where)
    return df if condition is None else df.filter(condition)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once: (unique_field, n_records).  Nulls are not compared."""
    field = F.col(column).alias("unique_field")
    counted = df.select(field).filter(F.col("unique_field").isNotNull()).groupBy("unique_field")
    return counted.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def not_null(df: DataFrame, column: str, whole_rows: bool = False) -> DataFrame:
    """Rows whose value is missing: the column alone, or whole rows when they are to be stored."""
    failing = df.filter(F.col(column).isNull())
    return failing if whole_rows else failing.select(column)


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Values outside the list: (value_field, n_records).  Nulls pass."""
    field = F.col(column).alias("value_field")
    counted = df.select(field).groupBy("value_field").agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(~F.col("value_field").isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent, one row per child row: (from_field).  Null children pass.

    The parent side is reduced to a list of its values first, and the child is the preserved side, so neither a hot
    parent value nor a hot child value ends up whole in one task.
    """
    known = key_list(parent.select(F.col(field).alias("from_field")), ["from_field"])
    values = child.select(F.col(column).alias("from_field")).filter(F.col("from_field").isNotNull())
    return values.join(known, "from_field", "left_anti")


def evaluate(
    failing: DataFrame,
    fail_calc: str = "count(*)",
    warn_if: str = "!= 0",
    error_if: str = "!= 0",
    limit: int | None = None,
) -> DataFrame:
    """One row (failures, should_warn, should_error) for a frame of failing rows."""
    rows = failing if limit is None else failing.limit(limit)
    counted = rows.agg(F.expr(fail_calc).alias("failures"))
    return counted.select(
        "failures",
        F.expr(f"failures {warn_if}").alias("should_warn"),
        F.expr(f"failures {error_if}").alias("should_error"),
    )


def evaluate_stored(
    failing: DataFrame, table: str, store_as: str = "table", limit: int | None = None, **thresholds: Any
) -> DataFrame:
    """Keep the failing rows, at most ``limit``, as a table or view, and judge the stored rows, so the test runs once."""
    from tidemark.plans.publish import replace_table

    if store_as not in STORE_AS:
        raise ValueError(f"failures are stored as one of {STORE_AS}, not {store_as!r}")
    rows = failing if limit is None else failing.limit(limit)
    if store_as == "ephemeral":
        return evaluate(rows, **thresholds)
    if store_as == "view":
        rows.createOrReplaceTempView(table)
    else:
        replace_table(rows, table)
    return evaluate(failing.sparkSession.table(table), **thresholds)


@dataclass(frozen=True)
class Check:
    """One entry of a suite: kind 'not_null', 'accepted_values', 'expression', 'unique' or 'relationships'."""

    kind: str
    column: str | None = None
    values: tuple[Any, ...] = ()
    expression: str | None = None
    name: str | None = None
    parent: DataFrame | None = None
    parent_column: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}_{self.column or 'expression'}"

    def broken(self) -> Column:
        """Condition of a failing row."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return is_true(~F.col(self.column).isin(list(self.values)))
        if self.kind == "expression":
            return is_true(~F.expr(self.expression))
        raise ValueError(f"unknown check {self.kind!r}")


def suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Many tests over one table: (check_name, failures), failing rows or, for 'unique', repeated values.

    All row-wise checks share one pass.  All uniqueness checks share another: values are counted by (check, value), combined
    before the one shuffle.  Each relationship is an anti join.
    """
    for check in checks:
        if check.kind not in ("unique", "relationships"):
            check.broken()
    row_wise = [c for c in checks if c.kind not in ("unique", "relationships")]
    parts = []
    if row_wise:
        counted = df.agg(*[F.count_if(c.broken()).alias(f"_{i}") for i, c in enumerate(row_wise)])
        pairs = [
            F.struct(F.lit(c.label).alias("check_name"), F.col(f"_{i}").alias("failures"))
            for i, c in enumerate(row_wise)
        ]
        parts.append(counted.select(F.inline(F.array(*pairs))))
    by_type: dict[T.DataType, list[Check]] = {}
    for check in checks:
        if check.kind == "unique":
            by_type.setdefault(df.select(check.column).schema[0].dataType, []).append(check)
    for same_type in by_type.values():
        cells = [F.struct(F.lit(c.label).alias("check_name"), F.col(c.column).alias("value")) for c in same_type]
        values = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
        repeated = values.groupBy("check_name", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        found = repeated.groupBy("check_name").agg(F.count(F.lit(1)).alias("failures"))
        names = df.sparkSession.createDataFrame([(c.label,) for c in same_type], "check_name string")
        known = names.join(found, "check_name", "left")
        parts.append(known.select("check_name", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")))
    for check in checks:
        if check.kind == "relationships":
            orphans = relationships(df, check.column, check.parent, check.parent_column or check.column)
            parts.append(orphans.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(check.label).alias("check_name"), "failures"))
    if not parts:
        raise ValueError("no checks given")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# -- unit tests -------------------------------------------------------------------------------------------------


def _plain(value: Any) -> Any:
    """Python values as given, anything else as text to be converted by Spark."""
    if value is None or isinstance(value, (bool, int, float, decimal.Decimal, dt.date, list, dict, tuple)):
        return value
    return str(value)


def fixture(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """A small hand-written frame: missing columns are null, names ignore case, unknown ones are an error.

    Texts are converted to the column's type (an unconvertible one is an error); numbers in numeric columns may be
    written in any numeric type; nested values as Python lists and dicts.  No rows gives an empty frame.
    """
    known = {f.name.lower(): f for f in schema.fields}
    unknown = sorted({n for row in rows for n in row if n.lower() not in known})
    if unknown:
        raise ValueError(f"unknown columns {unknown}; the relation has {[f.name for f in schema.fields]}")
    if not rows:
        return spark.createDataFrame([], schema)
    given = [{n.lower(): v for n, v in row.items()} for row in rows]
    raw, cells = [], []
    for field in schema.fields:
        values = [_plain(row.get(field.name.lower())) for row in given]
        kinds = {_raw_type(v) for v in values if v is not None}
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            kind = field.dataType
        elif len(kinds) == 1 and not any(isinstance(k, T.DecimalType) for k in kinds):
            (kind,) = kinds
        else:  # of several types, or none: as texts, which Spark converts
            kind = T.StringType()
            values = [v if v is None else _text(v) for v in values]
        raw.append(T.StructField(field.name, kind))
        cells.append(values)
    frame = spark.createDataFrame(list(zip(*cells, strict=True)), T.StructType(raw))
    return frame.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _text(value: Any) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return str(value)


def _raw_type(value: Any) -> T.DataType:
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, decimal.Decimal):
        return T.DecimalType(38, max(0, -value.as_tuple().exponent))
    if isinstance(value, dt.datetime):
        return T.TimestampNTZType() if value.tzinfo is None else T.TimestampType()
    if isinstance(value, dt.date):
        return T.DateType()
    return T.StringType()


def unit_test(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows telling what was expected and what came out: the expected columns, side and copies.

    Only the columns the expectation names are compared, so an expectation may be partial.
    """
    return row_diff(expected, actual.select(*expected.columns))

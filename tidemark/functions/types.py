"""Portable type names, casts and null-aware equality."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, functions as F, types as T

STRING = T.StringType()
TIMESTAMP = T.TimestampNTZType()
FLOAT = T.DoubleType()
NUMERIC = T.DecimalType(28, 6)
BIGINT = T.LongType()
INTEGER = T.IntegerType()
BOOLEAN = T.BooleanType()
DATE = T.DateType()

_FAMILIES = {
    "string": (T.StringType, T.VarcharType, T.CharType),
    "float": (T.FloatType, T.DoubleType),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "numeric": (T.DecimalType,),
}


def type_family(data_type: T.DataType) -> str | None:
    """'string', 'float', 'integer', 'numeric', or None for anything else."""
    return next((name for name, kinds in _FAMILIES.items() if isinstance(data_type, kinds)), None)


def cast(field: Column, data_type: T.DataType | str) -> Column:
    """Convert; a value that does not convert is an error (ANSI mode)."""
    return field.cast(data_type)


def safe_cast(field: Column, data_type: T.DataType | str) -> Column:
    """Convert; a value that does not convert becomes null."""
    return field.try_cast(data_type)


def equals(a: Column, b: Column, null_safe: bool = False) -> Column:
    """Plain equality (null is never equal), or null-safe equality where null equals null."""
    return a.eqNullSafe(b) if null_safe else a == b


def literal(value: Any, data_type: T.DataType) -> Column:
    """A Python value as a literal of a type.

    A wall-clock datetime goes as text: a plain literal would pass through the driver's time zone and old calendar.
    """
    if isinstance(value, dt.datetime) and value.tzinfo is None and not isinstance(data_type, T.TimestampType):
        return F.lit(value.isoformat(sep=" ")).cast(TIMESTAMP).cast(data_type)
    return F.lit(value).cast(data_type)


def text_of(field: Column, data_type: T.DataType) -> Column:
    """A stable text form of a value: timestamps always carry six fractional digits, instants are in UTC."""
    if isinstance(data_type, T.TimestampType):
        epoch = literal(dt.datetime(1970, 1, 1), TIMESTAMP)
        field = F.timestamp_add("MICROSECOND", F.unix_micros(field), epoch)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        # Formatting functions would go through the session's time zone.
        text = field.cast("string")
        return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
    return field.cast("string")

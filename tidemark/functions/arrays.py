"""Array construction and joining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def array_construct(values: Sequence[Column], element_type: str = "int") -> Column:
    """An array of the given elements; an empty one still carries its element type."""
    built = F.array(*values)
    return built if values else built.cast(f"array<{element_type}>")


def array_append(array: Column, element: Column) -> Column:
    return F.array_append(array, element)


def array_concat(first: Column, second: Column) -> Column:
    return F.concat(first, second)

"""Python models: a function from a context to a frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.incremental import newer_than_target
from tidemark.plans.publish import table_exists


@dataclass(frozen=True)
class Context:
    """What a model sees: its inputs by name, its settings, and its own earlier content."""

    spark: SparkSession
    this: str
    inputs: Mapping[str, DataFrame | Callable[[SparkSession], DataFrame]] = field(default_factory=dict)
    config: Mapping[str, Any] = field(default_factory=dict)

    def ref(self, name: str) -> DataFrame:
        """An input given as a frame, as a function building one (inlined, never stored), or a catalog table."""
        found = self.inputs.get(name)
        if found is None:
            return self.spark.table(name)
        return found if isinstance(found, DataFrame) else found(self.spark)

    @property
    def is_incremental(self) -> bool:
        return table_exists(self.spark, self.this)

    def new_rows(self, df: DataFrame, column: str) -> DataFrame:
        """Rows above the model's own high-water mark."""
        return newer_than_target(df, self.spark.table(self.this) if self.is_incremental else None, column)


def run_model(model: Callable[[Context], Any], context: Context) -> DataFrame:
    """The model's result as a Spark frame; pandas and pandas-on-Spark results are converted."""
    result = model(context)
    if isinstance(result, DataFrame):
        return result
    if isinstance(result, pd.DataFrame):
        return context.spark.createDataFrame(result)
    if hasattr(result, "to_spark"):
        return result.to_spark()
    raise TypeError(f"a model returns a Spark, pandas or pandas-on-Spark frame, not {type(result).__name__}")

"""User-defined functions: SQL scalar functions, Arrow-batched Python functions and mergeable Python aggregates."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.types import type_family


@dataclass(frozen=True)
class Arg:
    """One typed argument; ``default`` is a SQL literal used when a caller leaves the argument out."""

    name: str
    data_type: str
    default: str | None = None

    def declare(self) -> str:
        suffix = "" if self.default is None else f" DEFAULT {self.default}"
        return f"`{self.name}` {self.data_type}{suffix}"


def create_sql_function(spark: SparkSession, name: str, args: Sequence[Arg], returns: str, body: str) -> str:
    """Register a SQL scalar function.  Catalyst inlines the body, so calls stay in generated code."""
    optional = False
    for arg in args:
        if arg.default is None and optional:
            raise ValueError(f"argument {arg.name!r} needs a default because an earlier one has it")
        optional = optional or arg.default is not None
    declared = ", ".join(arg.declare() for arg in args)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION `{name}`({declared}) RETURNS {returns} RETURN {body}")
    return name


def create_python_function(spark: SparkSession, name: str, function: Callable[..., pd.Series], returns: str):
    """Register a vectorised Python function: it gets and returns pandas Series, moved in Arrow batches."""
    if not callable(function):
        raise ValueError("the entry point must be callable")
    registered = F.pandas_udf(function, returnType=returns)
    spark.udf.register(name, registered)
    return registered


class MergeableAggregate(Protocol):
    """An aggregate with a state that can be built in pieces and merged in any order."""

    def init(self) -> Any: ...

    def accumulate(self, state: Any, values: pd.Series) -> Any: ...

    def merge(self, left: Any, right: Any) -> Any: ...

    def finish(self, state: Any) -> Any: ...


#: Rows a task gathers before it folds them, and groups it holds before it sends their partial states on.  Both bound
#: memory and leave the result unchanged.
FOLD_ROWS = 200_000
PARTIAL_GROUPS = 50_000
#: Rows of a group, among those gathered, from which on they are folded before the shuffle.  Fewer travel as they are, so that
#: the Python calls for a group do not multiply with the tasks that hold some of its rows.
FOLDED_FROM = 16


def aggregate(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    function: MergeableAggregate,
    returns: str,
    alias: str,
    spread: int = 64,
) -> DataFrame:
    """Group with a Python aggregate, combining before every shuffle.

    Each input partition folds the rows of a group to a state wherever it has gathered FOLDED_FROM of them; the others, less
    than FOLDED_FROM of a group in FOLD_ROWS rows, are folded behind the shuffle, where the whole group has them together.
    States are merged per (group, slice) and then per group, each time streaming over sorted partitions with one state in
    hand, so a group holding much of the data never arrives at one task as rows, and its states arrive there already
    merged ``spread``-fold.
    """
    keys = list(by)
    # pandas would turn nullable integers into floats, and nulls among floats into NaN: such keys travel as text.
    as_text = {k for k in keys if type_family(df.schema[k].dataType) in ("integer", "float")}
    carried = [F.col(k).cast("string").alias(k) if k in as_text else F.col(k) for k in keys]
    rows = df.select(*carried, value)
    key_schema = T.StructType([rows.schema[k] for k in keys])
    state_schema = T.StructType([*key_schema.fields, T.StructField("_state", T.BinaryType())])
    mixed_schema = T.StructType([*state_schema.fields, T.StructField(value, rows.schema[value].dataType)])

    def plain(key: tuple) -> tuple:
        return tuple(None if pd.isna(part) else part for part in key)

    def fold(batches: list[pd.DataFrame], states: dict) -> pd.DataFrame:
        """Folds the rows of groups that have many, and returns the others."""
        gathered = pd.concat(batches, ignore_index=True)
        group = gathered.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        many = np.bincount(group)[group] >= FOLDED_FROM
        if many.any():
            for key, values in gathered[many].groupby(keys, dropna=False, sort=False)[value]:
                key = plain(key)
                state = states[key] if key in states else function.init()
                states[key] = function.accumulate(state, values)
        return gathered[~many].assign(_state=None)[[*keys, "_state", value]]

    def pack(states: Iterable[tuple[tuple, Any]]) -> pd.DataFrame:
        return pd.DataFrame([[*key, pickle.dumps(state)] for key, state in states], columns=[*keys, "_state"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        waiting: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size >= FOLD_ROWS:
                yield fold(waiting, states)
                waiting, size = [], 0
                if len(states) >= PARTIAL_GROUPS:
                    yield pack(states.items()).assign(**{value: None})
                    states = {}
        if waiting:
            yield fold(waiting, states)
        if states:
            yield pack(states.items()).assign(**{value: None})

    def runs(batch: pd.DataFrame) -> Iterator[tuple[tuple, int, int]]:
        """(key, first, end) of the rows of one key and one kind, in a batch sorted by both."""
        if batch.empty:
            return
        kind = batch["_state"].isna().to_numpy()
        changed = np.append(True, kind[1:] != kind[:-1])
        for k in keys:
            own, empty = batch[k].to_numpy(), batch[k].isna().to_numpy()
            changed[1:] |= (own[1:] != own[:-1]).astype(bool) & ~(empty[1:] & empty[:-1])
        first = np.flatnonzero(changed)
        heads = batch[keys].iloc[first].itertuples(index=False, name=None)
        yield from zip(map(plain, heads), first.tolist(), [*first[1:].tolist(), len(batch)], strict=True)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple[tuple, Any]]]:
        """States of partitions sorted by key, in chunks: rows are folded, states merged."""
        head, state, begun, done = None, None, False, []
        for batch in batches:
            blobs = batch["_state"].tolist()
            for key, first, end in runs(batch):
                if key != head:
                    if head is not None:
                        done.append((head, state))
                    head, begun = key, False
                if blobs[first] is None:
                    state = function.accumulate(state if begun else function.init(), batch[value].iloc[first:end])
                    begun = True
                    continue
                for blob in blobs[first:end]:
                    state = function.merge(state, pickle.loads(blob)) if begun else pickle.loads(blob)
                    begun = True
            if len(done) >= 10_000:
                yield done
                done = []
        if head is not None:
            done.append((head, state))
        if done:
            yield done

    def merge_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in merged(batches):
            yield pack(chunk)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in merged(batches):
            yield pd.DataFrame([[*key, function.finish(state)] for key, state in chunk], columns=[*keys, alias])

    names = [F.col(f"`{k}`") for k in keys]
    result_schema = T.StructType([*key_schema.fields, T.StructField(alias, T._parse_datatype_string(returns))])
    # Rows of a group stay together, whatever task they come from; there are few of each.
    slice_ = F.when(F.col("_state").isNull(), -1).otherwise(F.pmod(F.spark_partition_id(), F.lit(spread)))
    states = rows.mapInPandas(partial, mixed_schema).withColumn("_slice", slice_)
    sliced = states.repartition(*names, "_slice").sortWithinPartitions(*names, "_slice").drop("_slice")
    whole = sliced.mapInPandas(merge_slices, state_schema).repartition(*names).sortWithinPartitions(*names)
    finished = whole.mapInPandas(finish, result_schema)
    return finished.select(*[F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys], alias)


class SumSquared:
    """Square of the sum, as a mergeable aggregate."""

    def init(self) -> float:
        return 0.0

    def accumulate(self, state: float, values: pd.Series) -> float:
        return state + float(values.sum())

    def merge(self, left: float, right: float) -> float:
        return left + right

    def finish(self, state: float) -> float:
        return state * state

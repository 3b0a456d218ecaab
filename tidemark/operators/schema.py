"""Schema evolution, contracts and constraints."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.types import type_family
from tidemark.operators.keys import is_true, key_list, no_null, normalise_key, probably_among
from tidemark.operators.structs import conform_frame

log = logging.getLogger(__name__)

POLICIES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


class SchemaMismatch(ValueError):
    """A batch or a query does not have the columns it should."""


@dataclass(frozen=True)
class SchemaChange:
    """Differences between a source and a target schema (names compare without case)."""

    added: tuple[T.StructField, ...]
    removed: tuple[T.StructField, ...]
    retyped: tuple[tuple[str, T.DataType, T.DataType], ...]

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.retyped)

    def describe(self) -> str:
        return (
            f"in source, not in target: {[f.name for f in self.added]}; "
            f"in target, not in source: {[f.name for f in self.removed]}; "
            f"new types: {[(n, new.simpleString()) for n, _, new in self.retyped]}"
        )


def missing_columns(source: T.StructType, target: T.StructType) -> list[T.StructField]:
    """Fields of ``source`` that ``target`` has no column for."""
    known = {f.name.lower() for f in target.fields}
    return [f for f in source.fields if f.name.lower() not in known]


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    return a == b or (type_family(a) == "string" and type_family(b) == "string")


def diff(source: T.StructType, target: T.StructType) -> SchemaChange:
    """What changed from target to source; a wider text type is no change."""
    known = {f.name.lower(): f for f in source.fields}
    retyped = tuple(
        (f.name, f.dataType, known[f.name.lower()].dataType)
        for f in target.fields
        if f.name.lower() in known and not _same_type(f.dataType, known[f.name.lower()].dataType)
    )
    return SchemaChange(tuple(missing_columns(source, target)), tuple(missing_columns(target, source)), retyped)


def diff_frame(spark: SparkSession, source: T.StructType, target: T.StructType) -> DataFrame:
    """The differences as rows (column_name, change, old_type, new_type)."""
    change = diff(source, target)
    rows = [(f.name, "added", None, f.dataType.simpleString()) for f in change.added]
    rows += [(f.name, "removed", f.dataType.simpleString(), None) for f in change.removed]
    rows += [(n, "retyped", old.simpleString(), new.simpleString()) for n, old, new in change.retyped]
    return spark.createDataFrame(rows, "column_name string, change string, old_type string, new_type string")


def normalise_policy(policy: str | None) -> str:
    if policy in POLICIES:
        return policy
    if policy is not None:
        log.warning("unknown schema-change policy %r, using 'ignore'", policy)
    return "ignore"


def merge_types(target: T.DataType, source: T.DataType) -> T.DataType:
    """A nested type with the source's new struct fields added and the target's own retained."""
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        known = {f.name.lower(): f for f in source.fields}
        fields = []
        for field in target.fields:
            other = known.get(field.name.lower())
            merged = field.dataType if other is None else merge_types(field.dataType, other.dataType)
            fields.append(T.StructField(field.name, merged, True))
        fields += [T.StructField(f.name, f.dataType, True) for f in missing_columns(source, target)]
        return T.StructType(fields)
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return T.ArrayType(merge_types(target.elementType, source.elementType), True)
    if isinstance(target, T.MapType) and isinstance(source, T.MapType):
        return T.MapType(target.keyType, merge_types(target.valueType, source.valueType), True)
    return target


def evolved_schema(target: T.StructType, source: T.StructType, policy: str | None) -> T.StructType:
    """The schema a target has once a batch of the source's schema may be loaded under a policy.

    * ignore: unchanged; a target column the batch lacks is an error.
    * fail: any difference is an error.
    * append_new_columns: new columns (and new fields inside structs) are added, none dropped.
    * sync_all_columns: columns are added, dropped and retyped to be the source's.
    """
    policy = normalise_policy(policy)
    change = diff(source, target)
    if not source.fields:
        if policy in ("fail", "sync_all_columns"):
            raise SchemaMismatch("the batch has no columns")
        log.warning("the batch has no columns; the target's are kept")
        return target
    if policy == "fail" and change:
        raise SchemaMismatch(f"source and target columns differ: {change.describe()}")
    if policy == "ignore":
        if change.removed:
            raise SchemaMismatch(f"the batch lacks target columns {[f.name for f in change.removed]}")
        return target
    if policy == "append_new_columns":
        return merge_types(target, source)
    if policy == "sync_all_columns":
        known = {f.name.lower(): f for f in source.fields}
        kept = [known[f.name.lower()] for f in target.fields if f.name.lower() in known]
        names = [f.name for f in target.fields if f.name.lower() in known]
        fields = [T.StructField(n, f.dataType, True) for n, f in zip(names, kept)]
        return T.StructType([*fields, *change.added])
    return target


def reconcile(target: DataFrame, batch: DataFrame, policy: str | None) -> tuple[DataFrame, DataFrame]:
    """Target and batch brought to one schema under a policy.  Only projections: no shuffle, no extra scan."""
    schema = evolved_schema(target.schema, batch.schema, policy)
    return conform_frame(target, schema), conform_frame(batch, schema)


def retype(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Some columns in new types, in place."""
    return df.withColumns({name: F.col(f"`{name}`").cast(new) for name, new in types.items()})


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The frame in the contract's column order; any difference in names or types is an error listing both sides."""
    for field in contract.fields:
        if isinstance(field.dataType, T.DecimalType) and field.dataType.scale == 0:
            log.warning("contract column %r is numeric without a scale; fractions would be lost", field.name)
    change = diff(df.schema, contract)
    if change:
        raise SchemaMismatch(
            f"the query breaks its contract ({change.describe()}); "
            f"contract: {contract.simpleString()}; query: {df.schema.simpleString()}"
        )
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in contract.fields])


@dataclass(frozen=True)
class Constraint:
    """One rule a table must meet.

    kind: 'not_null', 'check', 'unique', 'primary_key', 'foreign_key' or 'custom' (a check with any SQL condition).
    """

    kind: str
    columns: tuple[str, ...] = ()
    condition: str | None = None
    parent: DataFrame | None = None
    parent_columns: tuple[str, ...] = ()
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or "_".join([self.kind, *self.columns])


KINDS = ("not_null", "check", "unique", "primary_key", "foreign_key", "custom")


def constraint_violations(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Number of violating rows per constraint: (constraint_name, violations).

    All row-wise rules are counted in one pass over the table.  Each key rule is one aggregation by key (combined
    before the shuffle); each reference one anti join against the parent's distinct keys.
    """
    row_rules: list[tuple[str, Column]] = []
    frames: list[DataFrame] = []
    for rule in constraints:
        if rule.kind not in KINDS:
            raise ValueError(f"unknown constraint kind {rule.kind!r}")
        present = no_null(rule.columns)
        if rule.kind in ("not_null", "primary_key"):
            row_rules.append((f"{rule.label}{'_null' if rule.kind == 'primary_key' else ''}", ~present))
        if rule.kind in ("check", "custom"):
            # As in SQL, a check whose condition is null holds.
            row_rules.append((rule.label, ~F.coalesce(F.expr(rule.condition), F.lit(True))))
        if rule.kind in ("unique", "primary_key"):
            repeated = (
                df.filter(present).groupBy(*normalise_key(rule.columns, df)).agg(F.count(F.lit(1)).alias("_n"))
            )
            surplus = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("bigint")
            frames.append(
                repeated.agg(surplus.alias("violations")).select(
                    F.lit(f"{rule.label}{'_repeated' if rule.kind == 'primary_key' else ''}").alias("constraint_name"),
                    "violations",
                )
            )
        if rule.kind == "foreign_key":
            parents = [F.col(p).alias(c) for p, c in zip(rule.parent_columns, rule.columns)]
            known = key_list(rule.parent.select(*parents), rule.columns)
            orphans = df.select(*rule.columns).filter(present).join(known, list(rule.columns), "left_anti")
            frames.append(
                orphans.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(rule.label).alias("constraint_name"), "violations"
                )
            )
    if row_rules:
        counted = df.agg(*[F.count_if(is_true(broken)).alias(f"_{i}") for i, (_, broken) in enumerate(row_rules)])
        pairs = [
            F.struct(F.lit(label).alias("constraint_name"), F.col(f"_{i}").alias("violations"))
            for i, (label, _) in enumerate(row_rules)
        ]
        frames.insert(0, counted.select(F.inline(F.array(*pairs))))
    if not frames:
        raise ValueError("no constraints given")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def enforce_keys(
    batch: DataFrame, held: DataFrame, constraints: Sequence[Constraint], staying: Callable[[DataFrame], DataFrame]
) -> None:
    """Raise if a key of the batch is that of a table's row, too, which stays beside the batch.

    A Bloom filter of the batch's keys picks the few rows of ``held`` that may clash; ``staying`` tells which of them the load
    leaves, and only these meet the batch.
    """
    broken = {}
    for rule in (c for c in constraints if c.kind in ("unique", "primary_key")):
        key = normalise_key(rule.columns, held, batch)
        keys = batch.select(*[F.col(f"`{k}`").cast(held.schema[k].dataType).alias(k) for k in key])
        rows = staying(probably_among(held, keys, key)).select(*[f"`{k}`" for k in key])
        if clashes := rows.join(key_list(keys, key), key, "left_semi").count():
            broken[rule.label] = clashes
    if broken:
        raise SchemaMismatch(f"keys of the batch are in the table already: {broken}")


def enforce_constraints(df: DataFrame, constraints: Sequence[Constraint]) -> None:
    """Raise if any constraint is violated (run before publishing)."""
    broken = constraint_violations(df, constraints).filter("violations > 0").collect()  # one row per constraint
    if broken:
        raise SchemaMismatch(f"constraints violated: { {r.constraint_name: r.violations for r in broken} }")

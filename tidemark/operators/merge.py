"""Upsert without a MERGE statement: matched rows are updated or deleted, the others inserted.

Conditions, predicates and rules may name columns of either side as ``target.x`` and ``batch.x``.

Plan shape.  Target rows that cannot match pass by without a shuffle.  The others are the preserved (left) side of a
join with the batch itself, so

* a small batch is broadcast by the optimiser's own size check and the target is never shuffled;
* a large batch gives a sort-merge join of two plain shuffles, in which adaptive execution splits a hot key on the
  target side (a full outer join, or an aggregation below the join, would not allow that);
* repeated batch keys are found by a count over the key columns alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.keys import (
    all_of,
    as_condition,
    error_if_any,
    is_true,
    key_list,
    key_match,
    no_null,
    normalise_key,
    repeated_keys,
)

Rule = str | Callable[[Column, Column], Column]


def _sum(new: Column, old: Column, data_type: T.DataType) -> Column:
    if not isinstance(data_type, T.MapType):
        return new + old
    zero = F.lit(0).cast(data_type.valueType)
    empty = F.create_map().cast(data_type)
    return F.map_zip_with(
        F.coalesce(new, empty), F.coalesce(old, empty), lambda _, a, b: F.coalesce(a, zero) + F.coalesce(b, zero)
    )


#: Ways to combine the batch's value (new) with the target's (old).
RULES: dict[str, Callable[[Column, Column, T.DataType], Column]] = {
    "replace": lambda new, old, _: new,
    "coalesce": lambda new, old, _: F.coalesce(new, old),
    "sum": _sum,
    "append": lambda new, old, _: F.concat(new, old),
    "append_distinct": lambda new, old, _: F.array_distinct(F.concat(new, old)),
}


def _combine(rule: Rule, name: str, data_type: T.DataType, target: str = "target") -> Column:
    new, old = F.col(f"batch.`{name}`"), F.col(f"{target}.`{name}`")
    if callable(rule):
        return rule(new, old)
    if rule in RULES:
        return RULES[rule](new, old, data_type)
    return F.expr(_with_names(rule, name, target))


#: Texts and quoted names, which stay as they are, and the whole names that stand for the two values.
_PLACES = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?<![\w.])(_new_|_old_)(?!\w)""")


def _with_names(rule: str, name: str, target: str) -> str:
    """A custom rule with ``_new_`` and ``_old_`` replaced by the batch's and the target's column."""
    sides = {"_new_": f"batch.`{name}`", "_old_": f"{target}.`{name}`"}
    return _PLACES.sub(lambda m: sides[m[1]] if m[1] else m[0], rule)


def updated_columns(
    columns: Sequence[str],
    key: Sequence[str],
    update_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
) -> list[str]:
    """Columns a matched row takes over: all, only the listed, or all but the listed; never the key."""
    if update_columns and exclude_columns:
        raise ValueError("give update_columns or exclude_columns, not both")
    candidates = [c for c in columns if c not in key]
    if update_columns:
        wanted = {c.lower() for c in update_columns}
        return [c for c in candidates if c.lower() in wanted]
    dropped = {c.lower() for c in exclude_columns or ()}
    return [c for c in candidates if c.lower() not in dropped]


def names_batch(condition: Column) -> bool:
    """Whether a condition names columns of the batch."""
    return re.search(r"(?<![\w.`])`?batch`?\.", str(condition)) is not None


def merge(
    target: DataFrame,
    batch: DataFrame,
    key: str | Sequence[str] | None,
    predicates: Column | str | Sequence[Column | str] | None = None,
    update_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    rules: Mapping[str, Rule] | None = None,
    default_rule: Rule = "replace",
    delete_condition: Column | str | None = None,
    update_condition: Column | str | None = None,
    insert_condition: Column | str | None = None,
    null_safe: bool = False,
    by_source: Mapping[str, Column | str] | str | None = None,
    by_source_condition: Column | str | None = None,
) -> DataFrame:
    """The target's content after merging ``batch`` into it.

    * A target row matches when every key part is equal and all ``predicates`` hold.  Null equals nothing, or null
      with ``null_safe``.  A row equal in key but outside the predicates is *not* matched, so its batch row is
      inserted beside it.
    * Matched rows meeting ``delete_condition`` go; of the rest, those meeting ``update_condition`` are updated.
    * Batch rows without a match are inserted if they meet ``insert_condition``; repeated ones are all inserted.
    * Target rows without a match that meet ``by_source_condition`` (all, if there is none) are deleted with
      ``by_source="delete"``, or updated with ``by_source={column: expression}``; by default they stay.
    * Without a key nothing matches and the batch is appended.
    * Two batch rows matching one target row are an error at run time (``latest_per_key`` removes such repeats).
    """
    columns = target.columns
    incoming = batch.select(*[F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) for c in columns])
    wanted = as_condition(insert_condition)
    key = normalise_key(key, target, batch)
    absent = _absent(by_source, by_source_condition, columns)
    if not key:
        new = incoming.alias("batch")
        kept = _without_match(target.alias("target"), by_source, absent)
        return kept.unionByName(new.filter(is_true(wanted)) if wanted is not None else incoming)

    updated = updated_columns(columns, key, update_columns, exclude_columns)
    predicate = as_condition(predicates)
    paired = predicate is not None and names_batch(predicate)

    # Rows that cannot match bypass the join: those outside the predicates, and null keys, which would all meet in one
    # task.  The filters reach the scan.
    complete = F.lit(True) if null_safe else is_true(no_null(key))
    reachable = complete if predicate is None or paired else complete & is_true(predicate)
    inside = target.alias("target").filter(reachable)
    outside = target.alias("target").filter(~reachable)
    keyed = incoming.filter(complete)
    on = key_match("target", "batch", key, null_safe)
    if paired:
        on = on & predicate
    joined = inside.join(keyed.withColumn("_hit", F.lit(True)).alias("batch"), on, "left")
    matched = F.col("batch._hit").isNotNull()

    removing = as_condition(delete_condition)
    kept = F.lit(True) if removing is None else ~(matched & is_true(removing))
    if by_source == "delete":
        kept = kept & (matched | ~absent)
    changing = as_condition(update_condition)
    updating = matched if changing is None else matched & is_true(changing)

    changes = by_source if isinstance(by_source, Mapping) else {}

    def result(name: str) -> Column:
        old = F.col(f"target.`{name}`")
        data_type = target.schema[name].dataType
        value = old
        if name in changes:
            value = F.when(~matched & absent, as_condition(changes[name]).cast(data_type)).otherwise(value)
        if name in updated:
            rule = (rules or {}).get(name, default_rule)
            value = F.when(updating, _combine(rule, name, data_type).cast(data_type)).otherwise(value)
        return value.alias(name)

    rewritten = joined.filter(kept).select(*[result(c) for c in columns])

    # Batch rows without a match.  Without conditions on the batch, the matched keys are few and found first.
    if paired:
        new = incoming.alias("batch").join(inside, on, "left_anti")
    else:
        keys = key_list(keyed, key, with_nulls=True).alias("batch")
        met = inside.select(*[f"`{k}`" for k in key]).alias("target").join(keys, on, "left_semi").distinct()
        new = incoming.alias("batch").join(met.alias("target"), on, "left_anti")
    if wanted is not None:
        new = new.filter(is_true(wanted))

    # A repeated batch key that matches is an error.  There are normally no repeated keys, and adaptive execution then
    # drops the whole check.
    repeated = repeated_keys(keyed, key).alias("repeated")
    again = key_match("target", "repeated", key, null_safe)
    clash = inside.join(repeated, again, "left_semi")
    if paired:
        # Distinct target rows against distinct batch rows with their number of copies.  Rows are told apart by a digest,
        # as columns of maps can't be compared.
        row = _digest(target)
        old = clash.withColumn("_row", row).dropDuplicates(["_row"]).alias("target")
        copies = (
            keyed.alias("target").join(repeated, again, "left_semi").withColumn("_row", row).groupBy("_row").agg(
                *[F.first(f"`{c}`").alias(c) for c in columns], F.count(F.lit(1)).alias("_copies")
            )
        )
        by_row = old.join(copies.alias("batch"), on).groupBy("target._row")
        clash = by_row.agg(F.sum("batch._copies").alias("_n")).filter("_n > 1")
    checked = error_if_any(clash, f"several batch rows match one target row on key {key}", target.schema)
    passing = _without_match(outside, by_source, absent)
    return rewritten.unionByName(passing).unionByName(new.select(*columns)).unionByName(checked)


def _absent(
    by_source: Mapping[str, Column | str] | str | None, condition: Column | str | None, columns: Sequence[str]
) -> Column:
    """Which target rows without a match are concerned."""
    if isinstance(by_source, Mapping):
        if unknown := [c for c in by_source if c not in columns]:
            raise ValueError(f"by_source names columns {unknown} that the target lacks: {columns}")
    elif by_source not in (None, "delete"):
        raise ValueError(f"by_source must be 'delete' or new values by column, not {by_source!r}")
    return F.lit(True) if condition is None else is_true(as_condition(condition))


def _without_match(rows: DataFrame, by_source: Mapping[str, Column | str] | str | None, absent: Column) -> DataFrame:
    """Rows of the target that have no match, after the clause for these."""
    if by_source is None:
        return rows
    if by_source == "delete":
        return rows.filter(~absent)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(
        *[
            F.when(absent, as_condition(by_source[c]).cast(kinds[c])).otherwise(F.col(f"target.`{c}`")).alias(c)
            if c in by_source
            else F.col(f"target.`{c}`")
            for c in rows.columns
        ]
    )


def _digest(df: DataFrame) -> Column:
    """A hash of a whole row; maps, which have no order, go in as text."""

    def has_map(kind: T.DataType) -> bool:
        inner = {T.ArrayType: lambda k: [k.elementType], T.StructType: lambda k: [f.dataType for f in k.fields]}
        return isinstance(kind, T.MapType) or any(has_map(k) for k in inner.get(type(kind), lambda _: [])(kind))

    cells = [(F.col(f"`{f.name}`"), has_map(f.dataType)) for f in df.schema.fields]
    parts = [F.to_json(F.struct(c.alias("v"))) if mapped else c for c, mapped in cells]
    return F.md5(F.concat_ws(" ", F.xxhash64(*parts), F.hash(*parts)))


def merge_into_v2(
    batch: DataFrame,
    table: str,
    key: Sequence[str],
    predicates: Column | str | Sequence[Column | str] | None = None,
    update_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    rules: Mapping[str, Rule] | None = None,
    default_rule: Rule = "replace",
    delete_condition: Column | str | None = None,
    update_condition: Column | str | None = None,
    insert_condition: Column | str | None = None,
    by_source: Mapping[str, Column | str] | str | None = None,
    by_source_condition: Column | str | None = None,
    delete_first: bool = False,
) -> None:
    """Native MERGE for tables whose format supports it (Delta, Iceberg, Hudi): only touched files are rewritten.

    Conditions and predicates as SQL texts name columns as ``target.x`` and ``batch.x``.  With ``delete_first`` matched rows are
    deleted and the whole batch is inserted, as delete+insert does.  That takes two statements: if the driver dies between
    them, the load must be repeated to bring the rows back.
    """
    spark = batch.sparkSession
    columns = spark.table(table).columns
    schema = spark.table(table).schema
    name = table.split(".")[-1]

    def own(condition: Column | str | Sequence[Column | str] | None) -> Column | None:
        """A condition whose SQL texts call the target by the table's name; Columns must do so themselves."""
        if isinstance(condition, (list, tuple)):
            return all_of([own(c) for c in condition]) if condition else None
        if isinstance(condition, str):
            return F.expr(re.sub(r"(?<![\w.`])`?target`?\.", f"`{name}`.", condition))
        return condition

    extra = own(predicates)
    condition = all_of([F.col(f"`{name}`.`{k}`") == F.col(f"batch.`{k}`") for k in key])
    condition = condition if extra is None else condition & extra
    if delete_first:
        # One statement can't both delete a row and insert beside it.
        listed = key_list(batch, key).distinct().alias("batch")
        listed.mergeInto(table, condition).whenMatched().delete().merge()
        batch.select(*[F.col(f"`{c}`") for c in columns]).writeTo(table).append()
        return
    updated = updated_columns(columns, key, update_columns, exclude_columns)
    chosen = {c: (rules or {}).get(c, default_rule) for c in updated}
    changes = {
        c: F.col(f"batch.`{c}`") if rule == "replace" else _combine(rule, c, schema[c].dataType, f"`{name}`").cast(schema[c].dataType)
        for c, rule in chosen.items()
    }
    statement = batch.alias("batch").mergeInto(table, condition)
    if delete_condition is not None:
        statement = statement.whenMatched(own(delete_condition)).delete()
    changing = own(update_condition)
    matched = statement.whenMatched() if changing is None else statement.whenMatched(changing)
    statement = matched.update(changes)
    wanted = own(insert_condition)
    new = statement.whenNotMatched() if wanted is None else statement.whenNotMatched(wanted)
    statement = new.insertAll()
    if by_source is not None:
        _absent(by_source, None, columns)  # says what is wrong with it
        lacking = own(by_source_condition)
        clause = statement.whenNotMatchedBySource() if lacking is None else statement.whenNotMatchedBySource(lacking)
        if by_source == "delete":
            statement = clause.delete()
        else:
            statement = clause.update({c: own(v).cast(schema[c].dataType) for c, v in by_source.items()})
    statement.merge()

"""Loading batches into tables.

A load reconciles schemas, picks a strategy and writes as little as the strategy allows: an append adds files, a
dynamic overwrite replaces the batch's partitions, and the rewriting strategies (merge, delete+insert, static
overwrite, event-time windows) rewrite only the partitions that hold a row they change.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.types import literal
from tidemark.operators import incremental as inc
from tidemark.operators.keys import (
    all_of,
    any_of,
    as_condition,
    free_names,
    is_true,
    key_list,
    key_match,
    normalise_key,
)
from tidemark.operators.merge import Rule, merge, merge_into_v2, names_batch
from tidemark.operators.partitions import copy_sources, hash_bucket
from tidemark.operators.schema import (
    Constraint,
    diff,
    enforce_constraints,
    enforce_contract,
    enforce_keys,
    normalise_policy,
    reconcile,
)
from tidemark.plans.filewise import files_holding, rewrite_files
from tidemark.plans.partitions import write_partitions
from tidemark.plans.publish import (
    is_view,
    partition_columns,
    properties_of,
    replace_table,
    set_properties,
    shape,
    table_exists,
)
from tidemark.plans.recovery import recover
from tidemark.session import cleaned_up, stage
from tidemark.sources.files import load_files, read_seed
from tidemark.sources.sinks import gathered, validate_format

STRATEGIES = ("append", "merge", "delete+insert", "insert_overwrite", "microbatch")
MICROBATCH_STYLES = ("overwrite", "delete+insert", "merge")

#: Formats whose tables take a native MERGE.
ROW_LEVEL_FORMATS = ("delta", "iceberg", "hudi")


@dataclass(frozen=True)
class Load:
    """Settings of one incrementally loaded table.

    ``partition_grain``: the stretch of event time that one partition holds, for microbatches by overwrite.
    ``contract`` and ``constraints``: checked on every batch before anything is written; a key constraint also against the
    table's rows that stay beside the batch.
    ``by_source`` and ``by_source_condition``: what a merge does to the table's rows that the batch lacks.
    ``rewrite``: 'table' replaces a table without partitions in one step; 'files' only those of its files that hold a changed
    row, in several (see ``filewise``).
    """

    strategy: str | None = None
    unique_key: str | Sequence[str] | None = None
    partition_by: Sequence[str] = ()
    predicates: Column | str | Sequence[Column | str] | None = None
    update_columns: Sequence[str] | None = None
    exclude_columns: Sequence[str] | None = None
    rules: Mapping[str, Rule] | None = None
    default_rule: Rule = "replace"
    delete_condition: Column | str | None = None
    update_condition: Column | str | None = None
    insert_condition: Column | str | None = None
    by_source: Mapping[str, Column | str] | str | None = None
    by_source_condition: Column | str | None = None
    overwrite_values: Sequence[Any] | None = None
    on_schema_change: str | None = "ignore"
    full_refresh: bool | None = None
    event_time: str | None = None
    batch_size: str | None = None
    microbatch_style: str | None = None
    partition_grain: str | None = None
    contract: T.StructType | None = None
    constraints: Sequence[Constraint] = ()
    file_format: str = "parquet"
    location: str | None = None
    rewrite: str = "table"

    @property
    def effective_strategy(self) -> str:
        """The named strategy, else merge with a key, partition overwrite with partitions, else append."""
        if self.strategy is not None:
            return self.strategy
        if normalise_key(self.unique_key):
            return "merge"
        return "insert_overwrite" if self.partition_by else "append"

    @property
    def effective_style(self) -> str:
        if self.microbatch_style is not None:
            return self.microbatch_style
        return "overwrite" if self.partition_by else "delete+insert"


def validate(cfg: Load) -> None:
    """Reject impossible settings before any job runs."""
    validate_format(cfg.file_format)
    strategy = cfg.effective_strategy
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if cfg.update_columns and cfg.exclude_columns:
        raise ValueError("give update_columns or exclude_columns, not both")
    if cfg.rewrite not in ("table", "files"):
        raise ValueError(f"rewrite must be 'table' or 'files', not {cfg.rewrite!r}")
    if cfg.by_source is not None and (strategy != "merge" or not normalise_key(cfg.unique_key)):
        raise ValueError("by_source needs a merge by a unique key")
    if cfg.by_source is None and cfg.by_source_condition is not None:
        raise ValueError("by_source_condition says when, by_source must say what")
    if cfg.overwrite_values is not None and len(cfg.partition_by) != 1:
        raise ValueError("a static overwrite needs exactly one partition column")
    if strategy == "microbatch":
        if not cfg.event_time or cfg.batch_size not in inc.BATCH_SIZES:
            raise ValueError(f"microbatches need an event_time and a batch_size out of {inc.BATCH_SIZES}")
        if cfg.effective_style not in MICROBATCH_STYLES:
            raise ValueError(f"microbatch_style must be one of {MICROBATCH_STYLES}")
        if cfg.effective_style == "overwrite" and not cfg.partition_by:
            raise ValueError("microbatches by overwrite need partition_by")
        if cfg.effective_style == "merge" and not normalise_key(cfg.unique_key):
            raise ValueError("microbatches by merge need a unique_key")
        if cfg.effective_style == "overwrite" and cfg.partition_grain not in (None, cfg.batch_size):
            raise ValueError(f"windows of a {cfg.batch_size} can't overwrite partitions of a {cfg.partition_grain}")


def _check_partitions(spark: SparkSession, table: str, cfg: Load) -> None:
    """The table is partitioned as the settings say; an overwrite would otherwise replace other rows than they mean."""
    actual = partition_columns(spark, table)
    if cfg.partition_by and [c.lower() for c in cfg.partition_by] != [c.lower() for c in actual]:
        raise ValueError(f"{table} is partitioned by {actual}, the settings say {list(cfg.partition_by)}; run a full refresh")


def _checked(batch: DataFrame, cfg: Load) -> DataFrame:
    """The batch, after its contract and constraints were enforced."""
    if cfg.contract is not None:
        batch = enforce_contract(batch, cfg.contract)
    if cfg.constraints:
        batch = stage(batch, "checked").frame
        enforce_constraints(batch, cfg.constraints)
    return batch


def _check_keys(batch: DataFrame, target: DataFrame, cfg: Load, window: Column | None = None) -> None:
    """Raise if a key constraint would be broken between the batch and what the load leaves in the table."""
    strategy = cfg.effective_strategy if window is None else cfg.effective_style
    key = normalise_key(cfg.unique_key, target, batch)

    def staying(rows: DataFrame) -> DataFrame:
        if strategy in ("merge", "delete+insert") and window is None or strategy == "merge":
            if not key:
                return rows
            extra = as_condition(cfg.predicates)
            paired = extra is not None and names_batch(extra)
            other = (batch if paired else key_list(batch, key)).alias("batch")
            on = key_match("target", "batch", key)
            return rows.alias("target").join(other, on if extra is None else on & extra, "left_anti")
        if window is not None:
            return rows.filter(~is_true(window))
        if strategy == "insert_overwrite" and cfg.overwrite_values is not None:
            return rows.filter(~is_true(F.col(f"`{cfg.partition_by[0]}`").isin(list(cfg.overwrite_values))))
        if strategy == "insert_overwrite":
            columns = list(cfg.partition_by)
            if not columns:
                return rows.limit(0)
            return rows.join(batch.select(*[f"`{c}`" for c in columns]).distinct(), columns, "left_anti")
        return rows

    enforce_keys(batch, target, cfg.constraints, staying)


def is_incremental(spark: SparkSession, table: str, cfg: Load, full_refresh: bool = False) -> bool:
    """Whether a load adds to the table: it exists and is not to be rebuilt (the setting outranks the flag)."""
    rebuild = cfg.full_refresh if cfg.full_refresh is not None else full_refresh
    return table_exists(spark, table) and not is_view(spark, table) and not rebuild


#: The property that names the last load that was given a name.
RUN = "tidemark.run"


def load(
    batch: DataFrame,
    table: str,
    cfg: Load,
    full_refresh: bool = False,
    run_id: str | None = None,
    marks: Mapping[str, str] | None = None,
) -> None:
    """Load one batch.

    A load that was interrupted has changed nothing, or all if it was past its last step: what it left behind is settled when
    the table is next loaded.  With a ``run_id`` a load is not taken again if it was the table's last one of that name, so one
    whose end is not known can be repeated whatever its rules.  ``marks``: properties that are set along with the rows.
    """
    validate(cfg)
    spark = batch.sparkSession
    marks = dict(marks or {})
    if table_exists(spark, table) and not is_view(spark, table):
        recover(spark, table)
        if run_id is not None and properties_of(spark, table).get(RUN) == run_id:
            return
    if run_id is not None:
        marks[RUN] = run_id
    with cleaned_up(spark):
        _load(_checked(batch, cfg), table, cfg, full_refresh, marks)


def _load(batch: DataFrame, table: str, cfg: Load, full_refresh: bool, marks: Mapping[str, str]) -> None:
    spark = batch.sparkSession
    if not is_incremental(spark, table, cfg, full_refresh):
        _rebuild(batch, table, cfg, marks)
        return
    _check_partitions(spark, table, cfg)
    batch = _evolve(batch, table, cfg)
    target = spark.table(table)
    strategy = cfg.effective_strategy
    key = normalise_key(cfg.unique_key, target, batch)
    _check_keys(batch, target, cfg)

    if strategy == "append" or (strategy in ("merge", "delete+insert") and not key):
        if strategy == "merge" and cfg.insert_condition is not None:
            batch = merge(target.limit(0), batch, None, insert_condition=cfg.insert_condition)
        _insert(batch, table)
        set_properties(spark, table, **marks)
    elif strategy == "insert_overwrite" and cfg.overwrite_values is not None:
        (column,) = cfg.partition_by
        values = list(cfg.overwrite_values)
        cleared = target.filter(F.col(column).isin(values)).select(column).distinct()
        _rewrite(batch, table, lambda old, new: inc.overwrite_listed(old, new, column, values), cleared, marks=marks)
    elif strategy == "insert_overwrite":
        if partition_columns(spark, table):
            # Rows without a partition value are added, not replacing.
            write_partitions(batch, table, marks=marks, keep_null=True)
        else:
            replace_table(inc.overwrite_all(target, batch), table, properties=marks)
    elif strategy in ("merge", "delete+insert") and shape(spark, table).provider in ROW_LEVEL_FORMATS:
        native = dict(delete_first=True) if strategy == "delete+insert" else _merge_settings(cfg)
        merge_into_v2(batch, table, key, cfg.predicates, **native)
        set_properties(spark, table, **marks)
    elif strategy == "delete+insert":
        _rewrite(
            batch, table, lambda old, new: inc.delete_insert(old, new, key, cfg.predicates), key=key, cfg=cfg, marks=marks
        )
    elif strategy == "merge":
        _rewrite(batch, table, lambda old, new: _merged(old, new, key, cfg), key=key, cfg=cfg, marks=marks)
    else:
        raise ValueError("microbatch loads go through load_microbatches")


def _merge_settings(cfg: Load) -> dict[str, Any]:
    return dict(
        update_columns=cfg.update_columns,
        exclude_columns=cfg.exclude_columns,
        rules=cfg.rules,
        default_rule=cfg.default_rule,
        delete_condition=cfg.delete_condition,
        update_condition=cfg.update_condition,
        insert_condition=cfg.insert_condition,
        by_source=cfg.by_source,
        by_source_condition=cfg.by_source_condition,
    )


def _merged(target: DataFrame, batch: DataFrame, key: Sequence[str], cfg: Load) -> DataFrame:
    return merge(target, batch, key, predicates=cfg.predicates, **_merge_settings(cfg))


def load_seed(spark: SparkSession, path: str, table: str, full_refresh: bool = False, **options: Any) -> None:
    """Load a CSV seed (see ``read_seed``).

    An existing table keeps its columns and types and gets the new rows in place of the old; with ``full_refresh`` it
    is built anew from the file.  A view of that name is an error.
    """
    if table_exists(spark, table) and is_view(spark, table):
        raise ValueError(f"cannot seed into {table}: it is a view")
    if full_refresh or not table_exists(spark, table):
        replace_table(read_seed(spark, path, **options), table)
        return
    declared = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields}
    texts = read_seed(spark, path, **{**options, "infer": False, "column_types": declared})
    if len(texts.columns) != len(declared):
        raise ValueError(f"the seed has columns {texts.columns}, the table {list(declared)}; run a full refresh")
    typed = [F.col(f"`{c}`").cast(kind).alias(c) for c, kind in declared.items()]
    replace_table(texts.select(*typed), table)


def load_file_table(
    spark: SparkSession, path: str, file_format: str, table: str, append: bool = False, **options: Any
) -> None:
    """Load files of any supported format into a table, replacing its rows or adding to them."""
    rows = load_files(spark, path, file_format, **options)
    if append and table_exists(spark, table):
        _insert(rows, table)
    else:
        replace_table(rows, table)


def copy_tables(spark: SparkSession, sources: Sequence[str], table: str, mode: str = "table") -> None:
    """Copy the rows of one or many tables into one: 'table' replaces its rows, 'incremental' adds to them."""
    rows, write_mode = copy_sources(*[spark.table(s) for s in sources], mode=mode)
    if write_mode == "append" and table_exists(spark, table):
        _insert(rows, table)
    else:
        replace_table(rows, table)


def load_in_parts(
    batch: DataFrame,
    table: str,
    cfg: Load,
    partitions_per_load: int,
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
) -> int:
    """Load a large batch a few partitions at a time; returns the number of loads.

    For loads whose output would not fit in one piece; the result is that of one load.  The batch is computed once and
    written by partition; every part then reads only its own.  With ``bucket_by`` and ``buckets``, those of the table, a part opens no
    more than ``partitions_per_load`` pairs of a partition and a bucket, so that even one partition may take several parts.  A
    full refresh, and the clearing of partitions, belong to the first part that concerns them.  Keys that occur in several
    partitions (pairs) of the batch must be loaded in one piece.
    """
    validate(cfg)
    if not cfg.partition_by or partitions_per_load < 1:
        raise ValueError("loading in parts needs partition_by and a positive number of partitions")
    if bool(bucket_by) != bool(buckets):
        raise ValueError("buckets need both columns and a number")
    spark = batch.sparkSession
    if is_incremental(spark, table, cfg):
        recover(spark, table)
        _check_partitions(spark, table, cfg)
    columns = list(cfg.partition_by)
    (bucket,) = free_names(batch.columns, "_bucket")
    by = [*columns, bucket] if buckets else columns
    with cleaned_up(spark):
        rows = _checked(batch, cfg)
        if buckets:
            rows = rows.withColumn(bucket, hash_bucket(list(bucket_by), buckets))
        kept = stage(rows, "parts", partition_by=by).frame
        staged = kept.select(batch.columns)
        key = normalise_key(cfg.unique_key, staged)
        if cfg.effective_strategy in ("merge", "delete+insert") and key:
            _reject_spread_keys(kept, key, by)
        if is_incremental(spark, table, cfg):
            _check_keys(staged, spark.table(table), cfg)
        parts = kept.select(*by).schema
        found = kept.select(*by).distinct().toLocalIterator()  # partition values (and buckets) only
        listed = sorted(found, key=lambda row: [str(v) for v in row])
        settings = replace(cfg, contract=None, constraints=())
        overwrites = cfg.effective_strategy == "insert_overwrite" and cfg.overwrite_values is None
        begun: set[tuple] = set()
        loads = 0
        for first in range(0, len(listed), partitions_per_load):
            chunk = listed[first : first + partitions_per_load]
            # A partition that an earlier part has replaced is added to.
            again = [row for row in chunk if overwrites and tuple(row[c] for c in columns) in begun]
            new = [row for row in chunk if row not in again]
            for some, how in ((new, settings), (again, replace(settings, strategy="append", full_refresh=False))):
                if not some:
                    continue
                exact = any_of(
                    [
                        all_of([F.col(f"`{f.name}`").eqNullSafe(literal(row[f.name], f.dataType)) for f in parts.fields])
                        for row in some
                    ]
                )
                load(kept.filter(exact).select(batch.columns), table, how)
                loads += 1
                settings = replace(settings, full_refresh=False)
                if cfg.overwrite_values is not None:
                    settings = replace(settings, strategy="append", overwrite_values=None)
            begun |= {tuple(row[c] for c in columns) for row in chunk}
    return loads


def _reject_spread_keys(batch: DataFrame, key: Sequence[str], columns: Sequence[str]) -> None:
    """Raise if a key occurs in several partitions: a later part would replace what an earlier one has loaded."""
    pairs = batch.select(*[F.col(f"`{k}`") for k in key], F.struct(*columns).alias("_part"))
    spread = pairs.groupBy(*[f"`{k}`" for k in key]).agg(F.min("_part").alias("_a"), F.max("_part").alias("_b"))
    if not spread.filter(~F.col("_a").eqNullSafe(F.col("_b"))).isEmpty():
        raise ValueError(f"values of the key {list(key)} occur in several partitions of the batch; load it in one piece")


def load_microbatches(
    source: DataFrame,
    table: str,
    cfg: Load,
    begin: dt.datetime,
    end: dt.datetime,
    windows_per_job: int | None = None,
    full_refresh: bool = False,
) -> int:
    """Load the event-time windows that ``[begin, end)`` meets, one after another; returns the number of windows.

    Windows are whole: the first is lowered to its start, the last raised to its end.  Every window reads only its
    slice of the source.  ``windows_per_job`` joins neighbouring windows into one load, with the same result; without
    it, windows go one by one, but all together into a table without partitions, which every load rewrites.
    """
    cfg = replace(cfg, strategy="microbatch")
    validate(cfg)
    spark = source.sparkSession
    windows = list(inc.batch_windows(begin, end, cfg.batch_size))
    rebuild = full_refresh
    if is_incremental(spark, table, cfg, rebuild):
        recover(spark, table)
        _check_partitions(spark, table, cfg)
        partitioned = bool(partition_columns(spark, table))
    else:
        partitioned = bool(cfg.partition_by)
    if windows_per_job is None:
        windows_per_job = 1 if partitioned else max(1, len(windows))
    elif windows_per_job < len(windows) and not partitioned:
        raise ValueError("every load rewrites a table without partitions: load all windows in one job, or partition it")
    for first in range(0, len(windows), windows_per_job):
        start, stop = windows[first][0], windows[min(first + windows_per_job, len(windows)) - 1][1]
        with cleaned_up(spark):
            batch = _checked(source.filter(inc.in_window(cfg.event_time, start, stop)), cfg)
            if not is_incremental(spark, table, cfg, rebuild):
                _rebuild(batch, table, cfg)
            else:
                _load_window(_evolve(batch, table, cfg), table, cfg, start, stop)
        rebuild, cfg = False, replace(cfg, full_refresh=False)
    return len(windows)


def _load_window(batch: DataFrame, table: str, cfg: Load, start: dt.datetime, stop: dt.datetime) -> None:
    style = cfg.effective_style
    spark = batch.sparkSession
    window = inc.in_window(cfg.event_time, start, stop)
    columns = partition_columns(spark, table)
    _check_keys(batch, spark.table(table), cfg, window)
    if style == "overwrite":
        # Partitions of the window that the batch has no rows for any more are emptied; one that also holds rows of other
        # windows would lose them.
        batch = stage(batch, "window").frame
        held = spark.table(table).filter(window).select(*columns).distinct()
        touched = batch.select(*columns).unionByName(held).distinct()
        same = key_match("t", "p", columns, null_safe=True)
        others = spark.table(table).filter(~is_true(window)).alias("t").join(touched.alias("p"), same, "left_semi")
        if not others.isEmpty():
            raise ValueError(f"partitions of {table} hold more than one window of a {cfg.batch_size}; overwrite can't be used")
        _rewrite(
            batch,
            table,
            lambda old, new: inc.microbatch_delete_insert(old, new, cfg.event_time, start, stop),
            held,
        )
    elif style == "merge":
        key = normalise_key(cfg.unique_key, batch)
        _rewrite(batch, table, lambda old, new: _merged(old, new, key, cfg), key=key, cfg=cfg)
    else:
        cleared = spark.table(table).filter(window).select(*columns).distinct() if columns else None
        _rewrite(
            batch,
            table,
            lambda old, new: inc.microbatch_delete_insert(old, new, cfg.event_time, start, stop),
            cleared,
        )


# -- writing ----------------------------------------------------------------------------------------------------


def _rebuild(df: DataFrame, table: str, cfg: Load, marks: Mapping[str, str] | None = None) -> None:
    replace_table(
        df,
        table,
        file_format=cfg.file_format,
        partition_by=cfg.partition_by,
        bucket_by=(),
        location=cfg.location,
        properties=marks,
    )


def _evolve(batch: DataFrame, table: str, cfg: Load) -> DataFrame:
    """Bring table and batch to one schema: new plain columns in place, anything else by a rewrite."""
    spark = batch.sparkSession
    target = spark.table(table)
    policy = normalise_policy(cfg.on_schema_change)
    old, new = reconcile(target, batch, policy)
    change = diff(old.schema, target.schema)
    if not change:
        return new
    if policy == "append_new_columns" and not change.retyped:
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in change.added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({declared})")
    else:
        replace_table(old, table, partition_by=[c for c in partition_columns(spark, table) if c in old.columns])
    return new


def _insert(batch: DataFrame, table: str) -> None:
    """Add rows by name (``insertInto`` goes by position, partition columns last)."""
    spark = batch.sparkSession
    rows = batch.select(*[F.col(f"`{c}`") for c in spark.table(table).columns])
    parts = partition_columns(spark, table)
    (gathered(rows, parts) if parts else rows).write.insertInto(table)


def _in_partitions(rows: Sequence[Any], schema: T.StructType) -> Column:
    """Per column, one of the values that occur: literals, so the scan skips the other partitions."""
    conditions = []
    for field in schema.fields:
        column, values = F.col(f"`{field.name}`"), {row[field.name] for row in rows}
        known = [literal(v, field.dataType) for v in values if v is not None]
        options = [column.isin(*known)] if known else []
        options += [column.isNull()] if None in values else []
        conditions.append(any_of(options))
    return all_of(conditions)


def _rewrite(
    batch: DataFrame,
    table: str,
    operator: Callable[[DataFrame, DataFrame], DataFrame],
    cleared: DataFrame | None = None,
    key: Sequence[str] = (),
    cfg: Load | None = None,
    marks: Mapping[str, str] | None = None,
) -> None:
    """Replace a table's content by ``operator(old, batch)``, reading and writing only the partitions concerned.

    Concerned are the batch's own partitions, those holding a key of the batch, and the ``cleared`` ones.  The operator
    runs once: the write itself tells which partitions got rows, and the concerned ones that got none are emptied.
    """
    spark = batch.sparkSession
    columns = partition_columns(spark, table)
    target = spark.table(table)
    batch = stage(batch, "batch").frame
    reachable = target
    extra = as_condition(cfg.predicates) if cfg else None
    if extra is not None and not names_batch(extra):
        reachable = target.alias("target").filter(extra)
    lacking = None  # rows that a clause for what the batch lacks may change
    if cfg is not None and cfg.by_source is not None:
        lacking = target.alias("target").filter(is_true(as_condition(cfg.by_source_condition or F.lit(True))))
    if not columns:
        if cfg is not None and cfg.rewrite == "files" and key:
            files = files_holding(reachable, batch, key)
            if lacking is not None:
                files = files.union(lacking.select(F.col("_metadata.file_path"))).distinct()
            if rewrite_files(batch, table, operator, files, marks):
                return
        replace_table(operator(target, batch), table, properties=marks)
        return

    touched = batch.select(*columns)
    if key:
        held = reachable.join(key_list(batch, key), list(key), "left_semi")
        touched = touched.unionByName(held.select(*columns))
    if lacking is not None:
        touched = touched.unionByName(lacking.select(*columns))
    if cleared is not None:
        touched = touched.unionByName(cleared)
    touched = stage(touched.distinct(), "touched").frame
    listed = touched.limit(inc.MAX_LISTED_PARTITIONS + 1).collect()  # partition values, at most the bound
    if not listed:
        set_properties(spark, table, **(marks or {}))
        return
    scope = target
    if len(listed) <= inc.MAX_LISTED_PARTITIONS:
        scope = target.filter(_in_partitions(listed, touched.schema))
    scope = scope.alias("t").join(touched.alias("p"), key_match("t", "p", columns, null_safe=True), "left_semi")

    texts = touched.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    concerned = (tuple(v or None for v in row) for row in texts.toLocalIterator())  # partition values
    write_partitions(operator(scope, batch), table, concerned, marks)

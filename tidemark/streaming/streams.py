"""Continuous loading with Structured Streaming.

Every stream keeps its progress in a checkpoint folder, and every sink can take a micro-batch again, so a lost
executor or a restarted driver repeats work without repeating rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import as_instant, as_time, as_utc, date_trunc, dateadd
from tidemark.operators.history import Snapshot
from tidemark.operators.keys import as_condition
from tidemark.operators.latest import latest_per_key
from tidemark.plans.load import ROW_LEVEL_FORMATS, Load, load
from tidemark.plans.partitions import write_partitions
from tidemark.plans.publish import properties_of, set_properties, shape, table_exists
from tidemark.plans.recovery import recover
from tidemark.plans.snapshot import append_changes
from tidemark.session import cleaned_up, stage


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files under a path, as a stream."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(
    stream: DataFrame, table: str, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    session = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        # The stream runs in a copy of the session; the caller's must forget the files it has listed.
        if session.catalog.tableExists(table):
            session.catalog.refreshTable(table)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to parquet files exactly once.  Without ``every`` it catches up and stops."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.outputMode("append").start()


def _mark(checkpoint: str) -> str:
    """The table property under which a stream's progress is kept."""
    return "tidemark.stream." + hashlib.md5(checkpoint.encode()).hexdigest()


def _settled(spark: SparkSession, table: str) -> dict[str, str]:
    """A table's properties, once what interrupted loads have left is settled; none if there is no table."""
    if not table_exists(spark, table):
        return {}
    recover(spark, table)
    return properties_of(spark, table)


#: Rules whose result is the same when a micro-batch is merged twice.
REPEATABLE = ("replace", "coalesce", "append_distinct")


def upsert_stream(
    stream: DataFrame,
    table: str,
    cfg: Load,
    order_by: Sequence[str],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into a table by key, the newest row of each key by the ``order_by`` columns.

    A row that is older than the table's by the same columns changes nothing, so deliveries may come out of order.  The table's
    properties name the last micro-batch that was merged, and a repeated one is skipped; the name is published with the rows, so
    a micro-batch counts once wherever the stream was stopped.  Tables in a row-level format can't do both in one step: there
    one that was begun but not recorded is merged again, unless its rules (sums, appends) would count it twice: that is an
    error, to be settled by hand.
    A full refresh rebuilds the table with the first micro-batch.  Plain-file tables must be partitioned: every
    micro-batch would rewrite the whole table.
    """
    key = [cfg.unique_key] if isinstance(cfg.unique_key, str) else list(cfg.unique_key or ())
    if not key:
        raise ValueError("an upsert stream needs a unique key")
    if not order_by or not all(isinstance(c, str) for c in order_by):
        raise ValueError("an upsert stream needs the names of the columns that order a key's rows, the greatest being the newest")
    if not cfg.partition_by and cfg.file_format in ("parquet", "orc", "json", "csv", "text"):
        raise ValueError("an upsert stream rewrites partitions; partition the table, for example by partitions.hash_bucket")
    newest = [F.desc(c) for c in order_by]
    later = " OR ".join(
        "(" + " AND ".join([*(f"batch.`{p}` <=> target.`{p}`" for p in order_by[:i]), f"batch.`{c}` > target.`{c}`"]) + ")"
        for i, c in enumerate(order_by)
    )
    equal = " AND ".join(f"batch.`{c}` <=> target.`{c}`" for c in order_by)
    not_older = F.expr(f"({later}) OR ({equal})") | F.col(f"target.`{order_by[0]}`").isNull()
    wanted = as_condition(cfg.update_condition)
    rules = [cfg.default_rule, *(cfg.rules or {}).values()]
    repeatable = all(rule in REPEATABLE for rule in rules)
    # Sums and appends take late rows in; only replacements go by age.
    if repeatable:
        wanted = not_older if wanted is None else wanted & not_older
    cfg = replace(cfg, update_condition=wanted)
    mark = _mark(checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = _settled(spark, table)
        if int(found.get(f"{mark}.done", -1)) >= batch_id:
            return
        if found and shape(spark, table).provider in ROW_LEVEL_FORMATS:
            if int(found.get(f"{mark}.begun", -1)) >= batch_id and not repeatable:
                raise RuntimeError(f"micro-batch {batch_id} may be in {table} already, and its rules would count it twice")
            set_properties(spark, table, **{f"{mark}.begun": str(batch_id)})
        settings = cfg if batch_id == 0 else replace(cfg, full_refresh=False)
        rows = latest_per_key(batch, key, newest) if repeatable else batch
        load(rows, table, settings, marks={f"{mark}.done": str(batch_id)})

    return _start(stream, table, handle, checkpoint, every)


def windowed_stream(
    stream: DataFrame,
    source: Callable[[SparkSession], DataFrame],
    table: str,
    event_time: str,
    size: str,
    transform: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    location: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Recompute every event-time window a micro-batch touches, late rows included.

    The windows' rows are read again from the full ``source`` and their partitions (column ``window_start``) are
    overwritten, so the result is what one batch run over everything would give.
    """
    column = "window_start"

    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(date_trunc(size, F.col(event_time)).alias(column)).distinct()
        bounds = touched.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
        if bounds["low"] is None:
            return
        # The range prunes the scan; the join keeps just the touched windows.
        low, high = (as_time(bounds[side]) for side in ("low", "high"))
        rows = source(spark).filter((F.col(event_time) >= low) & (F.col(event_time) < dateadd(size, 1, high)))
        rows = rows.withColumn(column, date_trunc(size, F.col(event_time))).join(touched, column, "left_semi")
        result = transform(rows)
        if not table_exists(spark, table):
            load(result, table, Load(strategy="insert_overwrite", partition_by=[column], location=location))
            return
        recover(spark, table)
        with cleaned_up(spark):
            concerned = stage(touched.select(F.col(column).cast("string")), "touched").frame
            write_partitions(result, table, (tuple(v) for v in concerned.toLocalIterator()))  # touched windows

    return _start(stream, table, handle, checkpoint, every)


def tumbling(
    stream: DataFrame,
    event_time: str,
    width: str,
    delay: str,
    by: Sequence[str],
    measures: dict[str, Column],
) -> DataFrame:
    """Aggregates per fixed window; rows later than ``delay`` behind the newest event are dropped.

    The watermark lets Spark forget finished windows, so the state is bounded by the delay, not by the stream.
    """
    moment = as_instant(F.col(event_time), stream.schema[event_time].dataType)
    timed = stream.withColumn("_time", moment).withWatermark("_time", delay)
    grouped = timed.groupBy(F.window("_time", width).alias("_w"), *by).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    bounds = [
        as_utc(F.col("_w.start"), T.TimestampType()).alias("window_start"),
        as_utc(F.col("_w.end"), T.TimestampType()).alias("window_end"),
    ]
    return grouped.select(*bounds, *by, *measures)


def history_stream(
    stream: DataFrame,
    table: str,
    cfg: Snapshot,
    order_by: Sequence[Column],
    checkpoint: str,
    clock_of: Callable[[int], dt.datetime] | None = None,
    location: str | None = None,
    every: str | None = None,
    operation: str | None = None,
    deletes: Sequence[str] = ("delete",),
) -> StreamingQuery:
    """Keep a type-2 history of a change stream.

    Every change in a micro-batch becomes a version, so the history does not depend on how the stream was cut; of rows
    with one key and one change time the newest by ``order_by`` counts.  Without a change time (checks by the clock) a
    micro-batch has one change of a key, also the newest.  A micro-batch holds changes, not the whole source, so keys
    missing from it are never taken as deleted: rows whose ``operation`` column is one of ``deletes`` tell that.  They
    close the key's version at their change time and, with 'new_record', start one that says so.  The operation is no
    column of the history.
    """
    if cfg.hard_deletes != "ignore" and operation is None:
        raise ValueError("without an operation column a change stream cannot tell deletions; use hard_deletes='ignore'")
    key = [cfg.key] if isinstance(cfg.key, str) else list(cfg.key)
    times = [cfg.strategy.updated_at] if cfg.strategy.updated_at is not None else []
    mark = _mark(checkpoint) + ".done"

    def handle(batch: DataFrame, batch_id: int) -> None:
        if int(_settled(batch.sparkSession, table).get(mark, -1)) >= batch_id:
            return
        moment = clock_of(batch_id) if clock_of is not None else None
        newest = latest_per_key(batch, [*key, *times], order_by)
        flag = None
        if operation is not None:
            flag = "_deleted"
            newest = newest.withColumn(flag, F.col(f"`{operation}`").isin(*deletes)).drop(operation)
        append_changes(newest, table, cfg, moment, location, marks={mark: str(batch_id)}, deleted=flag)

    return _start(stream, table, handle, checkpoint, every)

"""Structured Streaming over the events table.

Each query starts a stream that catches up with the files there are and stops, then returns what the sink holds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.demos.registry import ORACLES, demo, fresh_name, table
from tidemark.operators.history import Snapshot, timestamp_strategy
from tidemark.operators.incremental import in_window
from tidemark.operators.partitions import hash_bucket
from tidemark.plans.load import Load
from tidemark.plans.snapshot import read_history
from tidemark.session import scratch_path
from tidemark.streaming import streams

CUTS = [None, dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), None]


def _deliver(spark, sf, run, backwards=False):
    """The events arrive as three deliveries of files, in time order; after each the stream is run to its end."""
    path, checkpoint = scratch_path(spark, "event_deliveries"), scratch_path(spark, "checkpoint")
    events = table(spark, sf, "events")
    pieces = list(zip(CUTS[:-1], CUTS[1:]))
    for start, end in reversed(pieces) if backwards else pieces:
        events.filter(in_window("ts", start, end)).write.mode("append").parquet(path)
        run(streams.file_stream(spark, path), checkpoint).awaitTermination()


@demo("SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> 'error'")
def stream_append(spark, sf):
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    path = scratch_path(spark, "appended")

    def run(stream, checkpoint):
        return streams.append_stream(stream.filter("event_type <> 'error'").select(*columns), path, checkpoint)

    _deliver(spark, sf, run)
    return spark.read.schema(table(spark, sf, "events").select(*columns).schema).parquet(path)


@demo(
    """
    SELECT user_id, ts, event_id, event_type, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
    WHERE place = 1
    """
)
def stream_upsert(spark, sf):
    return _upserted(spark, sf, _deliver)


def _upserted(spark, sf, deliver):
    """The newest event of each user, kept by a stream in a table of a few partitions."""
    name = fresh_name("last_event")
    cfg = Load(unique_key="user_id", partition_by=["bucket"], location=scratch_path(spark, name))
    columns = ["user_id", "ts", "event_id", "event_type", "value"]

    def run(stream, checkpoint):
        rows = stream.select(*columns, hash_bucket("user_id", 4).alias("bucket"))
        return streams.upsert_stream(rows, name, cfg, ["ts", "event_id"], checkpoint)

    deliver(spark, sf, run)
    return spark.table(name).select(*columns)


@demo(ORACLES["stream_upsert"])
def stream_upsert_out_of_order(spark, sf):
    # The deliveries come newest first: an older row in a later one changes nothing.
    return _upserted(spark, sf, lambda *args: _deliver(*args, backwards=True))


@demo(
    """
    SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS events,
           count(DISTINCT user_id) AS users
    FROM events GROUP BY ALL
    """
)
def stream_microbatch(spark, sf):
    # Distinct users per day cannot be added up from pieces: touched days are computed again from the whole table.
    name = fresh_name("daily_events")
    location = scratch_path(spark, name)

    def per_day(rows):
        return rows.groupBy("event_type", "window_start").agg(
            F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users")
        )

    def everything(session):
        return table(session, sf, "events")

    def run(stream, checkpoint):
        return streams.windowed_stream(stream, everything, name, "ts", "day", per_day, checkpoint, location=location)

    _deliver(spark, sf, run)
    return spark.table(name)


@demo(
    """
    SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS events,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS window_start FROM events)
    WHERE window_start + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    GROUP BY window_start, event_type
    """
)
def stream_tumbling(spark, sf):
    # A window is final, and written, once the newest event is an hour past its end.
    path = scratch_path(spark, "windows")
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    measures = {"events": F.count(F.lit(1)), "total": total}

    def run(stream, checkpoint):
        windows = streams.tumbling(stream, "ts", "6 hours", "1 hour", ["event_type"], measures)
        return streams.append_stream(windows, path, checkpoint)

    _deliver(spark, sf, run)
    return spark.read.parquet(path)


@demo(
    """
    WITH last AS (
      SELECT user_id, event_type, ts FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS place FROM events)
      WHERE place = 1)
    SELECT user_id, event_type, ts, ts AS scd_updated_at, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
           md5(CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id
    FROM last
    """
)
def stream_scd(spark, sf):
    # Every event becomes its user's next version, wherever the stream was cut.
    name = fresh_name("user_history")
    location = scratch_path(spark, name)
    cfg = Snapshot("user_id", timestamp_strategy("ts"))
    newest = [F.desc("ts"), F.desc("event_id")]

    def run(stream, checkpoint):
        rows = stream.select("event_id", "user_id", "event_type", "ts")
        return streams.history_stream(rows, name, cfg, newest, checkpoint, location=location)

    _deliver(spark, sf, run)
    return read_history(spark, name).drop("event_id")


@demo(
    """
    WITH last AS (
      SELECT user_id, event_type, ts, event_type = 'error' AS gone FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS place FROM events)
      WHERE place = 1),
    kept AS (
      SELECT *, md5(CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS id
      FROM (SELECT *, lag(gone, 1, TRUE) OVER (PARTITION BY user_id ORDER BY ts) AS absent FROM last)
      WHERE NOT (gone AND absent)),
    lined AS (
      SELECT *, lag(event_type) OVER w AS old_type, lag(ts) OVER w AS old_ts, lag(id) OVER w AS old_id,
             lead(ts) OVER w AS valid_to
      FROM kept WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    SELECT user_id, CASE WHEN gone THEN old_type ELSE event_type END AS event_type,
           CASE WHEN gone THEN old_ts ELSE ts END AS ts, ts AS scd_updated_at, ts AS valid_from, valid_to,
           CASE WHEN gone THEN md5(old_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) ELSE id END AS scd_id,
           CASE WHEN gone THEN 'True' ELSE 'False' END AS is_deleted
    FROM lined
    """
)
def stream_scd_deletes(spark, sf):
    # An error deletes its user, who comes back with the next event; the cuts of the deliveries don't show.
    name = fresh_name("user_lives")
    location = scratch_path(spark, name)
    cfg = Snapshot("user_id", timestamp_strategy("ts"), hard_deletes="new_record")
    newest = [F.desc("ts"), F.desc("event_id")]

    def run(stream, checkpoint):
        op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
        rows = stream.select("event_id", "user_id", "event_type", "ts", op.alias("op"))
        return streams.history_stream(rows, name, cfg, newest, checkpoint, location=location, operation="op")

    _deliver(spark, sf, run)
    return read_history(spark, name).drop("event_id")

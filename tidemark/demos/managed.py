"""Loads, snapshots and refreshes through catalog tables, with the rows their tables must hold afterwards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.demos.history import COLUMNS, FIRST, LOOKS, SECOND, _first_look, _second_look
from tidemark.demos.loading import (
    BOTH,
    BY_YEAR,
    EVENT_LOADS,
    RELOAD_FROM,
    RELOAD_UNTIL,
    _batch,
    _corrected_events,
    _loaded_events,
    _target,
    _with_year,
)
from tidemark.demos.registry import demo, fresh_name, table
from tidemark.functions.dates import as_time
from tidemark.operators import freshness, quality
from tidemark.operators.history import Snapshot, check_strategy, hard_deletes_from, timestamp_strategy, with_meta
from tidemark.operators.history import apply as apply_history
from tidemark.operators.history import first_build
from tidemark.operators.incremental import max_partition
from tidemark.operators.latest import latest_shards, shard_family, union_shards
from tidemark.operators.merge import merge
from tidemark.plans.aggregates import AggregateTable, Measure
from tidemark.plans.load import Load, copy_tables, load, load_file_table, load_in_parts, load_microbatches, load_seed
from tidemark.plans.materialized import FollowingTable
from tidemark.plans.model import Context, run_model
from tidemark.plans.snapshot import read_history, take_snapshot
from tidemark.session import scratch_path
from tidemark.sources.sinks import write_files

YEARS = dict(partition_by=["order_year"])


def _place(spark, label, **settings):
    """A fresh table name, and settings that put the table below the shared folder."""
    name = fresh_name(label)
    return name, Load(location=scratch_path(spark, name), **settings)


def _day(df):
    return df.withColumn("day", F.col("ts").cast("date"))


@demo("SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events")
def load_full_refresh_windows(spark, sf):
    # The table is built anew once, not with every window.
    name, cfg = _place(spark, "windows", event_time="ts", batch_size="day", partition_by=["day"], full_refresh=True)
    events = _day(table(spark, sf, "events").drop("props"))
    load(events.withColumn("value", F.lit(-1.0)), name, Load(partition_by=["day"], location=cfg.location))
    load_microbatches(events, name, cfg, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31), windows_per_job=8)
    return spark.table(name)


@demo(
    BOTH + BY_YEAR
    + "SELECT * FROM t WHERE order_year NOT IN (1996, 1999, 2000, 2001) UNION ALL SELECT * FROM b"
)
def load_parts_static(spark, sf):
    # The listed years are cleared once; every part then adds its own.
    name, cfg = _place(spark, "parts", strategy="insert_overwrite", overwrite_values=[1996, 1999, 2000, 2001], **YEARS)
    load(_with_year(_target(spark, sf)), name, Load(location=cfg.location, **YEARS))
    load_in_parts(_with_year(_batch(spark, sf)), name, cfg, 1)
    return spark.table(name)


@demo(
    EVENT_LOADS
    + """
    SELECT *, CAST(ts AS DATE) AS day FROM target WHERE ts < TIMESTAMP '2024-01-18'
    UNION ALL SELECT *, CAST(ts AS DATE) AS day FROM source
    """
)
def micro_overwrite_partial_end(spark, sf):
    # The range ends within a day; that day's window is loaded whole.
    name, cfg = _place(spark, "partial", event_time="ts", batch_size="day", partition_by=["day"], partition_grain="day")
    load(_day(_loaded_events(spark, sf)), name, Load(partition_by=["day"], location=cfg.location))
    end = RELOAD_UNTIL - dt.timedelta(hours=10, minutes=3)
    load_microbatches(_day(_corrected_events(spark, sf)), name, cfg, RELOAD_FROM, end, windows_per_job=4)
    return spark.table(name)


@demo(EVENT_LOADS + "SELECT * FROM target WHERE ts < TIMESTAMP '2024-01-18' UNION ALL SELECT * FROM source")
def micro_table_delete_insert(spark, sf):
    name, cfg = _place(spark, "windows_di", event_time="ts", batch_size="day", file_format="orc")
    load(_loaded_events(spark, sf), name, Load(location=cfg.location, file_format="orc"))
    load_microbatches(_corrected_events(spark, sf), name, cfg, RELOAD_FROM, RELOAD_UNTIL)
    return spark.table(name)


@demo(
    EVENT_LOADS
    + """
    , both_ AS (SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM source)
                UNION ALL SELECT * FROM source)
    SELECT *, CAST(ts AS DATE) AS day FROM both_
    """
)
def micro_table_merge(spark, sf):
    name, cfg = _place(
        spark, "windows_m", event_time="ts", batch_size="day", partition_by=["day"], unique_key="event_id",
        microbatch_style="merge",
    )
    load(_day(_loaded_events(spark, sf)), name, Load(partition_by=["day"], location=cfg.location))
    load_microbatches(_day(_corrected_events(spark, sf)), name, cfg, RELOAD_FROM, RELOAD_UNTIL, windows_per_job=4)
    return spark.table(name)


def _moved(df):
    """Orders of 1999 are put into 2050, which takes rows out of one partition into a new one."""
    year = F.year("o_orderdate")
    return df.withColumn("order_year", F.when(year == 1999, 2050).otherwise(year))


MOVED = """
    , t AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM target
            WHERE o_orderdate >= TIMESTAMP '1999-07-01'),
      b AS (SELECT *, CAST(CASE WHEN year(o_orderdate) = 1999 THEN 2050 ELSE year(o_orderdate) END AS INTEGER)
                     AS order_year FROM batch)
    SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) UNION ALL SELECT * FROM b
"""


def _late_target(spark, sf):
    return _with_year(_target(spark, sf).filter(F.col("o_orderdate") >= as_time(dt.datetime(1999, 7, 1))))


@demo(BOTH + MOVED)
def load_merge_partitioned(spark, sf):
    # Every order of 1999 moves to another partition, so its old one is emptied and goes.
    name, cfg = _place(spark, "merged", unique_key="o_orderkey", **YEARS)
    load(_late_target(spark, sf), name, cfg)
    load(_moved(_batch(spark, sf)), name, cfg)
    assert spark.sql(f"SHOW PARTITIONS {name}").filter("partition = 'order_year=1999'").isEmpty()
    return spark.table(name)


@demo(BOTH + MOVED)
def load_delete_insert_partitioned(spark, sf):
    name, cfg = _place(spark, "replaced", strategy="delete+insert", unique_key="o_orderkey", **YEARS)
    load(_late_target(spark, sf), name, cfg)
    load(_moved(_batch(spark, sf)), name, cfg)
    return spark.table(name)


@demo(
    BOTH + BY_YEAR
    + "SELECT * FROM t WHERE order_year NOT IN (1996, 2000) UNION ALL SELECT * FROM b WHERE order_year = 2000"
)
def load_static_overwrite(spark, sf):
    name, cfg = _place(spark, "listed", strategy="insert_overwrite", overwrite_values=[1996, 2000], **YEARS)
    load(_with_year(_target(spark, sf)), name, Load(location=cfg.location, **YEARS))
    load(_with_year(_batch(spark, sf)).filter("order_year = 2000"), name, cfg)
    return spark.table(name)


@demo(
    """
    SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(12, 2)) AS s_acctbal
    FROM supplier WHERE s_acctbal > 0
    """
)
def load_seed_again(spark, sf):
    # The second seed replaces the rows and keeps the types of the first.
    name = fresh_name("suppliers")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    for rows, types in ((suppliers, {"s_acctbal": "decimal(12,2)"}), (suppliers.filter("s_acctbal > 0"), {})):
        path = scratch_path(spark, "seed")
        write_files(rows, path, file_format="csv", options={"header": "true"})
        load_seed(spark, path, name, column_types=types)
    return spark.table(name)


@demo(
    BOTH
    + """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS channel FROM target
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 'web' FROM batch
    """
)
def load_schema_sync(spark, sf):
    # The batch brings a column and has lost two; table and rows follow.
    name, cfg = _place(spark, "synced", unique_key="o_orderkey", on_schema_change="sync_all_columns")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    load(_target(spark, sf).select(*columns, "o_orderstatus", "o_orderdate"), name, cfg)
    load(_batch(spark, sf).select(*columns, F.lit("web").alias("channel")), name, cfg)
    return spark.table(name).select(*columns, "channel")


@demo(
    BOTH
    + """
    , hit AS (SELECT t.o_orderkey FROM target t JOIN batch b ON t.o_orderkey = b.o_orderkey
              WHERE b.o_totalprice > t.o_totalprice + 50 AND t.o_orderstatus <> 'P')
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority AS tag FROM target
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM hit)
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'new ' || o_orderpriority FROM batch
    """
)
def inc_merge_paired_map(spark, sf):
    # The predicate compares both sides, and the rows carry a map, which no set operation takes.
    def tagged(df, prefix):
        tags = F.create_map(F.lit("tag"), F.concat(F.lit(prefix), F.col("o_orderpriority")))
        return df.select("o_orderkey", "o_orderstatus", "o_totalprice", tags.alias("tags"))

    merged = merge(
        tagged(_target(spark, sf), ""), tagged(_batch(spark, sf), "new "), "o_orderkey",
        predicates=["batch.o_totalprice > target.o_totalprice + 50", "target.o_orderstatus <> 'P'"],
    )
    return merged.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("tags")["tag"].alias("tag"))


# -- snapshots --------------------------------------------------------------------------------------------------


@demo(
    LOOKS
    + """
    , old AS (SELECT * FROM s0), new_ AS (SELECT * FROM s1),
      changed AS (SELECT n.* FROM new_ n LEFT JOIN old o ON n.o_orderkey = o.o_orderkey
                  WHERE o.o_orderkey IS NULL OR o.o_orderdate < n.o_orderdate)
    SELECT o.*, md5(CAST(o.o_orderkey AS VARCHAR) || '|' || strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
           o.o_orderdate AS scd_updated_at, o.o_orderdate AS valid_from,
           (SELECT max(c.o_orderdate) FROM changed c WHERE c.o_orderkey = o.o_orderkey) AS valid_to
    FROM old o
    UNION ALL
    SELECT c.*, md5(CAST(c.o_orderkey AS VARCHAR) || '|' || strftime(c.o_orderdate, '%Y-%m-%d %H:%M:%S.%f')),
           c.o_orderdate, c.o_orderdate, CAST(NULL AS TIMESTAMP)
    FROM changed c
    """
)
def scd_table_two_runs(spark, sf):
    # The second look is taken in two halves by runs with the same clock; what the first half closed stays closed.
    name = fresh_name("order_history")
    cfg = Snapshot("o_orderkey", timestamp_strategy("o_orderdate"))
    place = scratch_path(spark, name)
    take_snapshot(_first_look(spark, sf), name, cfg, FIRST, place)
    second = _second_look(spark, sf)
    take_snapshot(second.filter("o_orderkey % 2 = 0"), name, cfg, SECOND)
    take_snapshot(second, name, cfg, SECOND)
    return read_history(spark, name)


@demo("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS closed FROM orders")
def scd_hard_deletes_setting(spark, sf):
    # The older yes/no setting of deletions: orders gone from the source are closed.
    orders = table(spark, sf, "orders").select(*COLUMNS)
    cfg = Snapshot("o_orderkey", check_strategy("all"), hard_deletes=hard_deletes_from(invalidate_hard_deletes=True))
    seen = apply_history(first_build(orders, cfg, FIRST), orders.filter("o_orderstatus <> 'F'"), cfg, SECOND)
    return seen.select("o_orderkey", F.col("valid_to").isNotNull().cast("int").alias("closed"))


@demo("SELECT o_orderkey, TIMESTAMP '2002-01-01' AS since, CAST(NULL AS TIMESTAMP) AS until FROM orders")
def scd_renamed_meta(spark, sf):
    cfg = with_meta(Snapshot("o_orderkey", check_strategy("all")), valid_from="since", valid_to="until")
    return first_build(table(spark, sf, "orders"), cfg, FIRST).select("o_orderkey", "since", "until")


# -- files, copies, shards --------------------------------------------------------------------------------------


@demo("SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_regionkey = 1")
def load_bulk_files(spark, sf):
    nations, path, more = table(spark, sf, "nation"), scratch_path(spark, "bulk"), scratch_path(spark, "more")
    write_files(nations, path, file_format="json")
    write_files(nations.filter("n_regionkey = 1"), more, file_format="json")
    name = fresh_name("nations")
    load_file_table(spark, path, "json", name, schema=nations.schema)
    load_file_table(spark, more, "json", name, append=True, schema=nations.schema)
    return spark.table(name)


@demo("SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS shard FROM events")
def shards_union(spark, sf):
    # One table a day, joined again with the day each row came from.
    events = table(spark, sf, "events").select("event_id", "user_id", F.date_format("ts", "yyyyMMdd").alias("d"))
    days = [r.d for r in events.select("d").distinct().collect()]  # as many as there are daily tables
    return union_shards({f"events_{d}": events.filter(F.col("d") == d).drop("d") for d in days})


@demo(
    """
    SELECT 'events_' AS family, 'events_' || max(strftime(ts, '%Y%m%d')) AS latest,
           'events_' || min(strftime(ts, '%Y%m%d')) AS oldest, count(DISTINCT strftime(ts, '%Y%m%d')) AS shards
    FROM events
    """
)
def shards_latest(spark, sf):
    days = table(spark, sf, "events").select(F.date_format("ts", "'events_'yyyyMMdd").alias("name")).distinct()
    return latest_shards(days).filter(shard_family("latest") == "events_")


@demo("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders WHERE year(o_orderdate) >= "
      "(SELECT max(year(o_orderdate)) FROM orders WHERE o_orderstatus = 'F')")
def inc_max_partition(spark, sf):
    orders = _with_year(table(spark, sf, "orders")).select("o_orderkey", "o_orderstatus", "order_year")
    top = max_partition(orders.filter("o_orderstatus = 'F'"), "order_year")
    return orders.filter(F.col("order_year") >= top).drop("o_orderstatus")


@demo("SELECT * FROM region UNION ALL SELECT * FROM region")
def copy_into_table(spark, sf):
    name = fresh_name("regions")
    table(spark, sf, "region").createOrReplaceTempView(f"{name}_source")
    copy_tables(spark, [f"{name}_source"], name)
    copy_tables(spark, [f"{name}_source"], name, mode="incremental")
    return spark.table(name)


@demo("SELECT true AS not_before, true AS recent")
def freshness_files(spark, sf):
    path = scratch_path(spark, "fresh")
    write_files(table(spark, sf, "region"), path)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(seconds=1)
    age = freshness.by_files(spark, path, now)
    return age.select((F.col("age") >= 0).alias("not_before"), (F.col("age") < 60).alias("recent"))


# -- tests, fixtures, models, following tables ------------------------------------------------------------------


@demo("SELECT CAST(least(25, count(*)) AS BIGINT) AS failures, CAST(least(25, count(*)) AS BIGINT) AS stored "
      "FROM lineitem WHERE l_quantity > 45")
def test_stored_limit(spark, sf):
    # The limit applies to what is stored, and the verdict to the stored rows.
    name = fresh_name("failures")
    failing = table(spark, sf, "lineitem").filter("l_quantity > 45")
    verdict = quality.evaluate_stored(failing, name, limit=25)
    return verdict.select("failures", F.lit(spark.table(name).count()).cast("bigint").alias("stored"))


@demo("SELECT count(*) AS differing FROM (SELECT n_regionkey FROM nation GROUP BY 1 HAVING count(*) <> 5)")
def unit_fixture(spark, sf):
    # Written by hand: five nations to a region.  Cells are texts and numbers, as they come.
    actual = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"))
    expected = quality.fixture(
        spark, [{"N_REGIONKEY": str(i) if i % 2 else i, "nations": 5} for i in range(5)], actual.schema
    )
    return quality.unit_test(actual, expected).agg(F.count(F.lit(1)).alias("differing"))


@demo("SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1")
def model_python(spark, sf):
    def by_status(context):
        return context.ref("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))

    return run_model(by_status, Context(spark, fresh_name("model"), {"orders": lambda s: table(s, sf, "orders")}))


@demo(
    """
    SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01'
    """
)
def following_table(spark, sf):
    # All prices change; a refresh follows, but for the rows declared immutable.
    name, view = fresh_name("following"), fresh_name("source")
    orders = table(spark, sf, "orders")
    orders.filter("o_orderstatus <> 'P' OR o_orderdate < timestamp_ntz'1998-01-01'").createOrReplaceTempView(view)
    follower = FollowingTable(
        name, lambda s: s.table(view), dt.timedelta(hours=1), location=scratch_path(spark, name),
        immutable_where="o_orderdate < timestamp_ntz'1998-01-01'",
    )
    follower.refresh_if_due(spark, FIRST)
    orders.withColumn("o_totalprice", F.col("o_totalprice") + 1).createOrReplaceTempView(view)
    follower.refresh_if_due(spark, SECOND)
    return spark.table(name)


@demo(
    LOOKS
    + """
    SELECT o_custkey, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18, 2)))::DOUBLE AS total,
           min(o_orderdate) AS earliest, max(o_orderdate) AS newest, max(o_totalprice) AS dearest,
           count(DISTINCT o_orderstatus) AS states
    FROM s1 GROUP BY o_custkey
    """
)
def mat_aggregates(spark, sf):
    # Late orders, orders that are gone and orders that have changed reach the stored aggregates as changes.
    name = fresh_name("by_customer")

    def priced(df):
        return df.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))

    before, after = priced(_first_look(spark, sf)), priced(_second_look(spark, sf))
    measures = {
        "orders": Measure("count"),
        "total": Measure("sum", "price"),
        "earliest": Measure("min", "o_orderdate"),
        "newest": Measure("max", "o_orderdate"),
        "dearest": Measure("max", "o_totalprice"),
        "states": Measure("count_distinct", "o_orderstatus"),
    }
    place = dict(buckets=8, location=scratch_path(spark, name))
    AggregateTable(name, lambda _: before, ["o_custkey"], measures, **place).create(spark)
    gone = before.exceptAll(after).withColumn("op", F.lit("delete"))
    changes = gone.unionByName(after.exceptAll(before).withColumn("op", F.lit("insert")))
    kept = AggregateTable(name, lambda _: after, ["o_custkey"], measures, **place)
    kept.apply(changes, "op", run_id="second")
    kept.apply(changes, "op", run_id="second")
    return kept.read(spark).withColumn("total", F.col("total").cast("double"))

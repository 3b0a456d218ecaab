"""Incremental loading.

The target holds the orders placed before mid-2000; the batch re-delivers the year before that with corrected prices
and adds everything later.  Together they cover the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.demos.registry import demo, fresh_name, table
from tidemark.functions.dates import as_time, datediff
from tidemark.operators import incremental as inc
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import merge
from tidemark.plans.load import Load, load, load_in_parts, load_microbatches
from tidemark.session import scratch_path

BATCH_FROM, TARGET_UNTIL = dt.datetime(1999, 7, 1), dt.datetime(2000, 7, 1)

#: The same two relations in SQL, put in front of every comparison query below.
BOTH = """
    WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01'),
         batch AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate,
                          o_orderpriority
                   FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01')
"""


def _target(spark, sf):
    return table(spark, sf, "orders").filter(inc.in_window("o_orderdate", None, TARGET_UNTIL))


def _batch(spark, sf):
    recent = table(spark, sf, "orders").filter(inc.in_window("o_orderdate", BATCH_FROM, None))
    return recent.withColumn("o_totalprice", F.col("o_totalprice") + 100)


def flagship(spark, sf):
    """Upsert the batch, then report amounts and the age of the loaded orders by status."""
    loaded = merge(_target(spark, sf), _batch(spark, sf), "o_orderkey")
    age = datediff(F.col("o_orderdate"), as_time(dt.datetime(2002, 1, 1)), "month")
    return loaded.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("amount"),
        F.min(age).alias("youngest_months"),
    )


@demo("SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND "
      "o_orderdate < TIMESTAMP '2000-07-01')")
def inc_high_water(spark, sf):
    orders = table(spark, sf, "orders")
    target = _target(spark, sf).filter("o_orderstatus = 'F'")
    return inc.newer_than_target(orders, target, "o_orderdate")


@demo(BOTH + "SELECT * FROM target UNION ALL SELECT * FROM batch")
def inc_append(spark, sf):
    return inc.append(_target(spark, sf), _batch(spark, sf))


@demo(BOTH + "SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch) UNION ALL SELECT * FROM batch")
def inc_delete_insert(spark, sf):
    return inc.delete_insert(_target(spark, sf), _batch(spark, sf), "o_orderkey")


@demo(
    BOTH
    + """
    SELECT * FROM target WHERE NOT (o_orderkey IN (SELECT o_orderkey FROM batch) AND o_orderstatus <> 'F')
    UNION ALL SELECT * FROM batch
    """
)
def inc_delete_insert_predicate(spark, sf):
    return inc.delete_insert(_target(spark, sf), _batch(spark, sf), "o_orderkey", predicates="o_orderstatus <> 'F'")


@demo(
    BOTH
    + """
    SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(b.o_custkey, t.o_custkey) AS o_custkey,
           coalesce(b.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
           coalesce(b.o_totalprice, t.o_totalprice) AS o_totalprice,
           coalesce(b.o_orderdate, t.o_orderdate) AS o_orderdate,
           coalesce(b.o_orderpriority, t.o_orderpriority) AS o_orderpriority
    FROM target t FULL JOIN batch b ON t.o_orderkey = b.o_orderkey
    """
)
def inc_merge_upsert(spark, sf):
    return merge(_target(spark, sf), _batch(spark, sf), "o_orderkey")


@demo(
    BOTH
    + """
    , hit AS (SELECT t.o_orderkey FROM target t JOIN batch b ON t.o_orderkey = b.o_orderkey
              WHERE t.o_orderdate >= TIMESTAMP '2000-01-01')
    SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM hit)
    UNION ALL SELECT * FROM batch
    """
)
def inc_merge_predicate(spark, sf):
    # Orders re-delivered from before 2000 are outside the predicate: they are inserted beside the old row.
    return merge(
        _target(spark, sf),
        _batch(spark, sf),
        "o_orderkey",
        predicates="target.o_orderdate >= timestamp_ntz'2000-01-01'",
    )


@demo(BOTH + "SELECT * FROM target UNION ALL SELECT * FROM batch")
def inc_merge_no_key(spark, sf):
    return merge(_target(spark, sf), _batch(spark, sf), [])


def _unranked(spark, sf):
    """The batch without the priorities of re-delivered orders."""
    again = F.col("o_orderdate") < as_time(TARGET_UNTIL)
    return _batch(spark, sf).withColumn("o_orderpriority", F.when(again, "?").otherwise(F.col("o_orderpriority")))


@demo(
    BOTH
    + """
    SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, coalesce(b.o_totalprice, t.o_totalprice) AS o_totalprice,
           t.o_orderdate, t.o_orderpriority
    FROM target t LEFT JOIN (SELECT o_orderkey, o_totalprice FROM batch) b ON t.o_orderkey = b.o_orderkey
    UNION ALL SELECT * FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
    """
)
def inc_merge_update_cols(spark, sf):
    return merge(_target(spark, sf), _unranked(spark, sf), "o_orderkey", update_columns=["O_TOTALPRICE"])


@demo(
    BOTH
    + """
    SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate,
           CASE WHEN t.o_orderkey IN (SELECT o_orderkey FROM batch) THEN '?' ELSE t.o_orderpriority END
             AS o_orderpriority
    FROM target t
    UNION ALL SELECT * FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
    """
)
def inc_merge_exclude_cols(spark, sf):
    return merge(_target(spark, sf), _unranked(spark, sf), "o_orderkey", exclude_columns=["O_TotalPrice"])


@demo(
    BOTH
    + """
    SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus,
           CASE WHEN b.o_orderkey IS NOT NULL AND t.o_orderpriority <> '5-LOW' THEN b.o_totalprice
                ELSE t.o_totalprice END AS o_totalprice,
           t.o_orderdate, t.o_orderpriority
    FROM target t LEFT JOIN batch b ON t.o_orderkey = b.o_orderkey
    WHERE NOT (b.o_orderkey IS NOT NULL AND t.o_orderstatus = 'F' AND b.o_totalprice < 100000)
    UNION ALL
    SELECT * FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target) AND o_orderstatus <> 'P'
    """
)
def inc_merge_conditions(spark, sf):
    return merge(
        _target(spark, sf),
        _batch(spark, sf),
        "o_orderkey",
        delete_condition="target.o_orderstatus = 'F' AND batch.o_totalprice < 100000",
        update_condition="target.o_orderpriority <> '5-LOW'",
        insert_condition="batch.o_orderstatus <> 'P'",
    )


@demo(
    BOTH
    + """
    SELECT t.o_orderkey, t.o_custkey,
           CASE WHEN b.o_orderkey IS NULL THEN t.o_orderstatus ELSE t.o_orderstatus || '>' || b.o_orderstatus END
             AS o_orderstatus,
           CASE WHEN b.o_orderkey IS NULL THEN t.o_totalprice ELSE b.o_totalprice + t.o_totalprice END AS o_totalprice,
           t.o_orderdate, t.o_orderpriority
    FROM target t LEFT JOIN batch b ON t.o_orderkey = b.o_orderkey
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END
    FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
    """
)
def inc_merge_rules(spark, sf):
    batch = _batch(spark, sf).withColumn(
        "o_orderpriority", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    )
    return merge(
        _target(spark, sf),
        batch,
        "o_orderkey",
        rules={
            "o_totalprice": "sum",
            "o_orderpriority": "coalesce",
            "o_orderstatus": "concat(_old_, '>', _new_)",
        },
    )


#: Events before and after mid-month, as two deliveries of per-user summaries.
HALF = dt.datetime(2024, 1, 15)


def _halves(spark, sf):
    events = table(spark, sf, "events")
    return events.filter(inc.in_window("ts", None, HALF)), events.filter(inc.in_window("ts", HALF, None))


def _type_counts(events):
    """Per user a map from event type to count; the map is as long as there are event types."""
    counted = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    entries = F.collect_list(F.struct("event_type", "n"))
    return counted.groupBy("user_id").agg(F.map_from_entries(entries).alias("counts"))


@demo("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type")
def inc_merge_rule_map_sum(spark, sf):
    first, second = _halves(spark, sf)
    merged = merge(_type_counts(first), _type_counts(second), "user_id", default_rule="sum")
    return merged.select("user_id", F.explode("counts").alias("event_type", "n"))


def _type_lists(events):
    types = F.array_sort(F.collect_set("event_type"))
    return events.groupBy("user_id").agg(types.alias("all_types"), types.alias("distinct_types"))


@demo(
    """
    WITH a AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS l FROM events
               WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
         b AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS l FROM events
               WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1),
         c AS (SELECT user_id, count(DISTINCT event_type) AS n FROM events GROUP BY 1)
    SELECT coalesce(a.user_id, b.user_id) AS user_id, concat_ws(',', b.l, a.l) AS all_types, c.n AS distinct_types
    FROM a FULL JOIN b ON a.user_id = b.user_id JOIN c ON c.user_id = coalesce(a.user_id, b.user_id)
    """
)
def inc_merge_rule_arrays(spark, sf):
    first, second = _halves(spark, sf)
    merged = merge(
        _type_lists(first),
        _type_lists(second),
        "user_id",
        rules={"all_types": "append", "distinct_types": "append_distinct"},
    )
    return merged.select(
        "user_id",
        F.array_join("all_types", ",").alias("all_types"),
        F.size("distinct_types").cast("bigint").alias("distinct_types"),
    )


@demo(
    """
    SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
           o_totalprice + 100 AS o_totalprice, CAST(NULL AS TIMESTAMP) AS o_orderdate,
           CAST(NULL AS VARCHAR) AS o_orderpriority
    FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'
    """
)
def inc_overwrite_full(spark, sf):
    return inc.overwrite_all(_target(spark, sf), _batch(spark, sf), columns=["o_orderkey", "o_totalprice"])


BY_YEAR = """
    , t AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM target),
      b AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM batch)
"""


def _with_year(df):
    return df.withColumn("order_year", F.year("o_orderdate"))


@demo(
    BOTH + BY_YEAR
    + "SELECT * FROM t WHERE order_year NOT IN (SELECT order_year FROM b) UNION ALL SELECT * FROM b"
)
def inc_overwrite_dynamic(spark, sf):
    # Through a partitioned table: the load replaces the directories of the batch's years.
    cfg = Load(
        strategy="insert_overwrite", partition_by=["order_year"], location=scratch_path(spark, "orders_by_year")
    )
    name = fresh_name("orders_by_year")
    load(_with_year(_target(spark, sf)), name, cfg)
    load(_with_year(_batch(spark, sf)), name, cfg)
    return spark.table(name)


@demo(
    BOTH + BY_YEAR
    + "SELECT * FROM t WHERE order_year NOT IN (1996, 2000) UNION ALL SELECT * FROM b WHERE order_year = 2000"
)
def inc_overwrite_static(spark, sf):
    # 1996 is listed but the batch has no rows for it: it is cleared all the same.
    batch = _with_year(_batch(spark, sf)).filter("order_year = 2000")
    return inc.overwrite_listed(_with_year(_target(spark, sf)), batch, "order_year", [1996, 2000])


@demo(
    BOTH
    + """
    SELECT * FROM target
    WHERE date_trunc('month', o_orderdate) NOT IN
          (SELECT date_trunc('month', o_orderdate) FROM batch WHERE o_orderstatus = 'P' AND o_totalprice > 400000)
    UNION ALL SELECT * FROM batch WHERE o_orderstatus = 'P' AND o_totalprice > 400000
    """
)
def inc_overwrite_month(spark, sf):
    batch = _batch(spark, sf).filter("o_orderstatus = 'P' AND o_totalprice > 400000")
    return inc.overwrite_partitions(_target(spark, sf), batch, ["o_orderdate"], grain="month")


@demo(BOTH + BY_YEAR + "SELECT DISTINCT order_year, o_orderstatus FROM b")
def inc_partitions_touched(spark, sf):
    return inc.partitions_touched(_with_year(_batch(spark, sf)), ["order_year", "o_orderstatus"])


@demo(
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, l_shipdate, CAST(year(l_shipdate) AS INTEGER) AS ship_year
    FROM lineitem
    """
)
def inc_batched(spark, sf):
    cfg = Load(strategy="append", partition_by=["ship_year"], location=scratch_path(spark, "lines_by_year"))
    name = fresh_name("lines_by_year")
    load_in_parts(table(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate")), name, cfg, 3)
    return spark.table(name)


@demo(
    BOTH
    + """
    , t AS (SELECT o_custkey, o_orderstatus, count(*) AS n, max(o_orderdate) AS last_order FROM target GROUP BY ALL),
      b AS (SELECT o_custkey, o_orderstatus, count(*) AS n, max(o_orderdate) AS last_order FROM batch GROUP BY ALL)
    SELECT coalesce(b.o_custkey, t.o_custkey) AS o_custkey, coalesce(b.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
           coalesce(b.n, t.n) AS n, coalesce(b.last_order, t.last_order) AS last_order
    FROM t FULL JOIN b ON t.o_custkey = b.o_custkey AND t.o_orderstatus = b.o_orderstatus
    """
)
def inc_composite_key(spark, sf):
    key = ["o_custkey", "o_orderstatus"]

    def summary(df):
        return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last_order"))

    return merge(summary(_target(spark, sf)), summary(_batch(spark, sf)), [*key, "o_custkey"])


# -- event-time microbatches ------------------------------------------------------------------------------------

LOADED_UNTIL, RELOAD_FROM, RELOAD_UNTIL = dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 18), dt.datetime(2024, 1, 25)

#: Events loaded first (before the 20th), and a corrected source for the windows loaded again (18th to 25th).
EVENT_LOADS = """
    WITH target AS (SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-20'),
         source AS (SELECT event_id, ts, user_id, event_type, value + 1 AS value FROM events
                    WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-18' AND ts < TIMESTAMP '2024-01-25')
"""


def _loaded_events(spark, sf):
    events = table(spark, sf, "events").drop("props")
    return events.filter(inc.in_window("ts", None, LOADED_UNTIL))


def _corrected_events(spark, sf):
    events = table(spark, sf, "events").drop("props")
    return events.filter("event_type <> 'error'").withColumn("value", F.col("value") + 1)


@demo(
    EVENT_LOADS
    + """
    SELECT *, CAST(ts AS DATE) AS day FROM target
    WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM source)
    UNION ALL SELECT *, CAST(ts AS DATE) AS day FROM source
    """
)
def micro_overwrite(spark, sf):
    cfg = Load(
        strategy="append",
        partition_by=["day"],
        event_time="ts",
        batch_size="day",
        location=scratch_path(spark, "events_by_day"),
    )
    name = fresh_name("events_by_day")
    day = F.col("ts").cast("date")
    load(_loaded_events(spark, sf).withColumn("day", day), name, cfg)
    corrected = _corrected_events(spark, sf).withColumn("day", day)
    load_microbatches(corrected, name, cfg, RELOAD_FROM, RELOAD_UNTIL, windows_per_job=4)
    return spark.table(name)


@demo(
    EVENT_LOADS
    + "SELECT * FROM target WHERE ts < TIMESTAMP '2024-01-18' UNION ALL SELECT * FROM source"
)
def micro_delete_insert(spark, sf):
    # Neighbouring windows are one range.
    return inc.microbatch_delete_insert(
        _loaded_events(spark, sf), _corrected_events(spark, sf), "ts", RELOAD_FROM, RELOAD_UNTIL
    )


@demo(
    EVENT_LOADS
    + """
    SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM source) UNION ALL SELECT * FROM source
    """
)
def micro_merge(spark, sf):
    return inc.microbatch_merge(
        _loaded_events(spark, sf), _corrected_events(spark, sf), "event_id", "ts", RELOAD_FROM, RELOAD_UNTIL
    )


@demo(
    """
    SELECT * EXCLUDE (place)
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
    WHERE place = 1
    """
)
def win_latest_per_key(spark, sf):
    return latest_per_key(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])

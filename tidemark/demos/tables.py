"""Seeds, sinks, layouts, published tables and stored results: everything that goes through files or the catalog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from tidemark.demos.registry import demo, fresh_name, table
from tidemark.operators import partitions
from tidemark.plans.materialized import MaterializedTable
from tidemark.plans.publish import replace_table
from tidemark.session import scratch_path
from tidemark.sources.files import infer_types, load_files, read_seed
from tidemark.sources.sinks import file_ranges, files_read, interleaved_layout, sorted_layout, write_files, write_table


@demo(
    """
    SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, CAST(p_retailprice AS FLOAT) AS
           p_retailprice
    FROM part
    """
)
def seed_csv(spark, sf):
    path = scratch_path(spark, "part_seed")
    write_files(table(spark, sf, "part"), path, file_format="csv", options={"header": "true", "sep": "|"})
    return read_seed(spark, path, delimiter="|", column_types={"P_RETAILPRICE": "float"})


@demo(
    """
    SELECT 'event_id' AS column_name, 'bigint' AS inferred, CAST(max(event_id) AS VARCHAR) AS greatest FROM events
    UNION ALL SELECT 'ts', 'timestamp_ntz', strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') FROM events
    UNION ALL SELECT 'day', 'date', CAST(max(CAST(ts AS DATE)) AS VARCHAR) FROM events
    UNION ALL SELECT 'event_type', 'string', max(event_type) FROM events
    UNION ALL SELECT 'is_error', 'boolean', 'true' FROM events WHERE event_type = 'error' HAVING count(*) > 0
    UNION ALL SELECT 'value', 'double', CAST(CAST(max(value) AS DECIMAL(18, 2)) AS VARCHAR) FROM events
    UNION ALL SELECT 'props', 'string', max(props) FROM events
    """
)
def seed_infer(spark, sf):
    path = scratch_path(spark, "event_seed")
    events = table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("ts").cast("date").alias("day"),
        "event_type",
        (F.col("event_type") == "error").alias("is_error"),
        "value",
        "props",
    )
    options = {"header": "true", "escape": '"'}
    write_files(events, path, file_format="csv", options=options)
    kinds = infer_types(load_files(spark, path, "csv", **options))
    typed = read_seed(spark, path, column_types={"value": "decimal(18,2)"})
    greatest = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kinds[c].simpleString()).alias("inferred"),
            (
                F.date_format(F.max(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")
                if isinstance(kinds[c], T.TimestampNTZType)
                else F.max(c).cast("string")
            ).alias("greatest"),
        )
        for c in typed.columns
    ]
    return typed.agg(F.array(*greatest).alias("_g")).select(F.inline("_g"))


@demo(
    """
    SELECT f.format, c.c_nationkey, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM customer c, (SELECT unnest(['parquet', 'orc', 'json', 'csv']) AS format) f GROUP BY f.format, c.c_nationkey
    """
)
def sink_formats(spark, sf):
    customers = table(spark, sf, "customer")
    parts = []
    for file_format in ("parquet", "orc", "json", "csv"):
        path = scratch_path(spark, f"customer_{file_format}")
        write_files(customers, path, file_format=file_format)
        back = load_files(spark, path, file_format, schema=customers.schema)
        parts.append(back.select(F.lit(file_format).alias("format"), "c_nationkey", "c_acctbal"))
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    total = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")
    return both.groupBy("format", "c_nationkey").agg(F.count(F.lit(1)).alias("customers"), total.alias("total"))


@demo(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus, o_orderstatus = 'P' AS pruned
    FROM orders
    """
)
def sink_partitioned(spark, sf):
    # Everything that was written, and beside it whether the pruned read of one status has the row.
    path = scratch_path(spark, "orders_by_status")
    write_files(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]
    back = spark.read.parquet(path).select(*columns)
    pending = back.filter("o_orderstatus = 'P'").withColumn("pruned", F.lit(True))
    return pending.unionByName(back.filter("o_orderstatus <> 'P'").withColumn("pruned", F.lit(False)))


@demo(
    """
    SELECT c_custkey, c_mktsegment, count(o_orderkey) AS orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment
    """
)
def sink_bucketed(spark, sf):
    # Both sides bucketed alike: the join and the aggregation read co-located buckets and shuffle nothing.
    names = {}
    for source, key in (("customer", "c_custkey"), ("orders", "o_custkey")):
        names[source] = fresh_name(f"{source}_bucketed")
        write_table(
            table(spark, sf, source).withColumnRenamed(key, "custkey"),
            names[source],
            bucket_by=["custkey"],
            buckets=8,
            location=scratch_path(spark, names[source]),
        )
    joined = spark.table(names["customer"]).join(spark.table(names["orders"]), "custkey", "left")
    return joined.groupBy(F.col("custkey").alias("c_custkey"), "c_mktsegment").agg(
        F.count("o_orderkey").alias("orders")
    )


@demo(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate,
           l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-01' AS in_month
    FROM lineitem
    """
)
def layout_sorted(spark, sf):
    # Written in ship-date order, a month is a few neighbouring row groups; the filter skips the others.
    path = scratch_path(spark, "lines_sorted")
    write_files(sorted_layout(table(spark, sf, "lineitem"), ["l_shipdate"]), path)
    month = (F.col("l_shipdate") >= F.expr("timestamp_ntz'1998-03-01'")) & (
        F.col("l_shipdate") < F.expr("timestamp_ntz'1998-04-01'")
    )
    lines = spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    others = lines.filter(~month).withColumn("in_month", F.lit(False))
    return lines.filter(month).withColumn("in_month", F.lit(True)).unionByName(others)


@demo(
    """
    WITH found AS (SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 130000)
    SELECT 'compound' AS layout, o_orderkey, FALSE AS skips_more FROM found
    UNION ALL SELECT 'interleaved', o_orderkey, TRUE FROM found
    """
)
def layout_second_key(spark, sf):
    # A range on the second key: files sorted by both keys hold every price, interleaved ones a part of them.
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    keys, low, high = ["o_custkey", "o_totalprice"], 100_000.0, 130_000.0
    written, read = {}, {}
    for layout, rows in (("compound", sorted_layout(orders, keys, 16)), ("interleaved", interleaved_layout(orders, keys, 6, 16))):
        path = scratch_path(spark, layout)
        write_files(rows, path)
        written[layout] = spark.read.parquet(path)
        read[layout] = files_read(file_ranges(written[layout], keys), "o_totalprice", low, high)
    least, most = min(read, key=read.get), max(read.values())
    parts = [
        df.filter((F.col("o_totalprice") >= low) & (F.col("o_totalprice") < high)).select(
            F.lit(layout).alias("layout"), "o_orderkey", F.lit(layout == least and read[least] < most).alias("skips_more")
        )
        for layout, df in written.items()
    ]
    return parts[0].unionByName(parts[1])


@demo(
    """
    SELECT date_trunc('month', ts)::TIMESTAMP AS month, date_trunc('day', ts)::TIMESTAMP AS ingested,
           date_trunc('hour', ts)::TIMESTAMP AS hour, user_id - user_id % 25 AS user_range, count(*) AS events
    FROM events GROUP BY ALL
    """
)
def partition_transform(spark, sf):
    events = table(spark, sf, "events").withColumns(
        {
            "month": partitions.time_partition("ts", "month"),
            "hour": partitions.time_partition("ts", "hour"),
            "user_range": partitions.range_bucket("user_id", 0, 25),
        }
    )
    stamped = partitions.ingestion_partition(events, "ts", "day", name="ingested")
    return stamped.groupBy("month", "ingested", "hour", "user_range").agg(F.count(F.lit(1)).alias("events"))


@demo(
    """
    SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier
    """
)
def copy_union(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    path = scratch_path(spark, "partners")
    rows, mode = partitions.copy_sources(customers, suppliers, mode="table")
    write_files(rows, path, mode=mode)
    rows, mode = partitions.copy_sources(suppliers, mode="incremental")
    write_files(rows.select(*customers.columns), path, mode=mode)
    return spark.read.parquet(path)


@demo(
    """
    SELECT o_custkey, o_orderstatus, count(*) AS orders, CAST(2 * count(*) AS BIGINT) AS doubled
    FROM orders GROUP BY o_custkey, o_orderstatus
    """
)
def mat_table(spark, sf):
    # Published, then replaced by a query over itself: the new content is complete before it takes the old one's place.
    name = fresh_name("order_counts")
    location = scratch_path(spark, name)
    counts = table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    replace_table(counts, name, location=location)
    replace_table(spark.table(name).withColumn("doubled", F.col("orders") * 2), name, location=location)
    return spark.table(name)


@demo(
    """
    SELECT 'create,refresh,skip,replace' AS history, l_suppkey, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY l_suppkey
    """
)
def mv_refresh(spark, sf):
    name = fresh_name("supplier_lines")
    location = scratch_path(spark, name)

    def lines(*extra):
        def build(session):
            grouped = table(session, sf, "lineitem").groupBy("l_suppkey")
            return grouped.agg(F.count(F.lit(1)).alias("lines"), *extra)

        return build

    quantity = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    now = dt.datetime(2024, 1, 1)
    first = MaterializedTable(name, lines(), {"measures": ["lines"]}, location)
    wider = MaterializedTable(name, lines(quantity), {"measures": ["lines", "quantity"]}, location)
    done = [
        first.refresh(spark, now=now),
        first.refresh(spark, now=now),
        wider.refresh(spark, on_config_change="continue", now=now),
        wider.refresh(spark, now=now),
    ]
    return spark.table(name).withColumn("history", F.lit(",".join(done)))

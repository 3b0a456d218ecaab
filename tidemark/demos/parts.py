"""Loads in parts by partition and bucket, partition values from the catalog, and structs that grow inside maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.demos.loading import BOTH, _batch, _target, _with_year
from tidemark.demos.registry import demo, fresh_name, table
from tidemark.operators.partitions import hash_bucket
from tidemark.plans.load import Load, load, load_in_parts
from tidemark.plans.partitions import largest_partition
from tidemark.session import scratch_path


@demo("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year, TRUE AS within FROM orders")
def load_parts_buckets(spark, sf):
    # No part opens more than five pairs of a year and a bucket.
    name = fresh_name("pairs")
    orders = _with_year(table(spark, sf, "orders"))
    cfg = Load(strategy="append", partition_by=["order_year"], location=scratch_path(spark, name))
    loads = load_in_parts(orders, name, cfg, 5, bucket_by=["o_custkey"], buckets=4)
    pairs = orders.select("order_year", hash_bucket(["o_custkey"], 4)).distinct().count()
    return spark.table(name).withColumn("within", F.lit(loads == -(-pairs // 5)))


@demo(
    """
    SELECT CAST(max(year(o_orderdate)) AS INTEGER) AS top,
           CAST(max(year(o_orderdate)) FILTER (WHERE year(o_orderdate) < 1999) AS INTEGER) AS earlier
    FROM orders
    """
)
def inc_max_partition_catalog(spark, sf):
    name = fresh_name("years")
    cfg = Load(partition_by=["order_year"], location=scratch_path(spark, name))
    load(_with_year(table(spark, sf, "orders")), name, cfg)
    top, earlier = largest_partition(spark, name, "order_year"), largest_partition(spark, name, "order_year", F.col("order_year") < 1999)
    return spark.range(1).select(F.lit(top).cast("int").alias("top"), F.lit(earlier).cast("int").alias("earlier"))


@demo(
    BOTH
    + """
    SELECT o_orderkey, o_totalprice AS price, NULL AS priority FROM target
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM batch
    """
)
def schema_nested_map(spark, sf):
    # The batch's map holds structs with a further field; the table's older values get null there.
    name = fresh_name("maps")

    def mapped(df, *fields):
        return df.select("o_orderkey", F.create_map("o_orderstatus", F.struct(*fields)).alias("by_status"))

    price, priority = F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")
    cfg = Load(unique_key="o_orderkey", location=scratch_path(spark, name), on_schema_change="append_new_columns")
    load(mapped(_target(spark, sf), price), name, cfg)
    load(mapped(_batch(spark, sf), priority, price), name, cfg)
    value = F.map_values("by_status")[0]
    return spark.table(name).select("o_orderkey", value["price"].alias("price"), value["priority"].alias("priority"))

"""Merges that decide on what the batch lacks, keys that hold for whole tables, and rewrites of single files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.demos.loading import BOTH, TARGET_UNTIL, _batch, _target, _with_year
from tidemark.demos.registry import demo, fresh_name, table
from tidemark.functions.dates import as_time
from tidemark.operators.merge import merge
from tidemark.operators.schema import Constraint, SchemaMismatch
from tidemark.plans.load import Load, load
from tidemark.plans.publish import replace_table
from tidemark.session import scratch_path
from tidemark.sources.sinks import sorted_layout

#: The batch without a fifth of its orders.
FEWER = BOTH + ", b AS (SELECT * FROM batch WHERE o_orderkey % 5 <> 0)"


def _fewer(spark, sf):
    return _batch(spark, sf).filter("o_orderkey % 5 <> 0")


@demo(
    FEWER
    + """
    , kept AS (SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
                                      AND o_orderdate < TIMESTAMP '1999-07-01')
    SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM (SELECT * FROM kept UNION ALL SELECT * FROM b)
    """
)
def inc_merge_by_source(spark, sf):
    # Orders of the batch's year that it no longer has are deleted, also from partitions it has no row for.
    name = fresh_name("by_source")
    cfg = Load(
        unique_key="o_orderkey", partition_by=["order_year"], location=scratch_path(spark, name),
        by_source="delete", by_source_condition="target.o_orderdate >= TIMESTAMP_NTZ '1999-07-01'",
    )
    load(_with_year(_target(spark, sf)), name, cfg)
    load(_with_year(_fewer(spark, sf)), name, cfg)
    return spark.table(name)


@demo(
    FEWER
    + """
    SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 100000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
    UNION ALL SELECT * FROM b
    """
)
def inc_merge_by_source_update(spark, sf):
    return merge(
        _target(spark, sf), _fewer(spark, sf), "o_orderkey",
        by_source={"o_orderstatus": "'X'"}, by_source_condition="target.o_totalprice > 100000",
    )


@demo("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year, 1 AS refused FROM orders")
def load_unique_in_table(spark, sf):
    # The first batch repeats orders that the table holds and is refused before anything is written; the second doesn't.
    name = fresh_name("unique")
    cfg = Load(
        strategy="append", partition_by=["order_year"], location=scratch_path(spark, name),
        constraints=[Constraint("primary_key", ("o_orderkey",))],
    )
    orders = _with_year(table(spark, sf, "orders"))
    load(_with_year(_target(spark, sf)), name, cfg)
    refused = 0
    for batch in (_with_year(_batch(spark, sf)), orders.filter(F.col("o_orderdate") >= as_time(TARGET_UNTIL))):
        try:
            load(batch, name, cfg)
        except SchemaMismatch:
            refused += 1
    return spark.table(name).withColumn("refused", F.lit(refused))


@demo(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey BETWEEN 101 AND 110 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority, 1 AS files_changed
    FROM orders
    """
)
def inc_merge_files(spark, sf):
    # A table sorted by key; ten orders that stand side by side change.
    name = fresh_name("by_file")
    orders = table(spark, sf, "orders")
    replace_table(sorted_layout(orders, ["o_orderkey"], parts=16), name, location=scratch_path(spark, name))
    before = {r[0] for r in spark.table(name).select("_metadata.file_name").distinct().collect()}
    batch = orders.filter("o_orderkey BETWEEN 101 AND 110").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    load(batch, name, Load(unique_key="o_orderkey", rewrite="files"))
    after = {r[0] for r in spark.table(name).select("_metadata.file_name").distinct().collect()}
    # They may stand on either side of a border between two files.
    return spark.table(name).withColumn("files_changed", F.lit(1 if 1 <= len(before - after) <= 2 else len(before - after)))

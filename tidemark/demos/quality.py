"""Scans, joins, comparisons, schemas, data tests and freshness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from tidemark.demos.registry import demo, table
from tidemark.operators import compare, freshness, quality, schema, structs
from tidemark.operators.keys import key_match
from tidemark.sources.scan import preview, scan

# -- scans ------------------------------------------------------------------------------------------------------


@demo("SELECT o_orderstatus, count(*) AS orders, CAST(0 AS BIGINT) AS lines FROM orders GROUP BY o_orderstatus")
def scan_empty(spark, sf):
    # A query over an input scanned empty still has its shape: orders are there, their lines are not.
    lines = scan(table(spark, sf, "lineitem"), limit=0).select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    joined = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey", "left")
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count("l_quantity").alias("lines")
    )


@demo(
    """
    SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
    """
)
def scan_event_window(spark, sf):
    window = scan(
        table(spark, sf, "events"), event_time="ts", start=dt.datetime(2024, 1, 10), end=dt.datetime(2024, 1, 20)
    )
    return window.select("event_id", "ts", "user_id", "event_type", "value")


@demo("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def scan_limit(spark, sf):
    ranked = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return preview(ranked.orderBy(F.desc("o_totalprice"), "o_orderkey"), 10)


# -- projections over declared and nested columns ---------------------------------------------------------------


@demo("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18, 2)) AS o_totalprice FROM orders")
def project_contract(spark, sf):
    contract = T.StructType.fromDDL(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2)"
    )
    query = table(spark, sf, "orders").select(
        F.col("o_totalprice").cast("decimal(18,2)").alias("O_TOTALPRICE"), "o_orderstatus", "o_custkey", "o_orderkey"
    )
    return schema.enforce_contract(query, contract)


@demo(
    """
    SELECT c_custkey, c_acctbal < 0 AS no_detail, CASE WHEN NOT c_acctbal < 0 THEN c_mktsegment END AS first_field,
           CASE WHEN NOT c_acctbal < 0 THEN c_name END AS second_field, CAST(NULL AS BIGINT) AS third_field
    FROM customer
    """
)
def struct_reorder(spark, sf):
    detail = F.when(F.col("c_acctbal") >= 0, F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg")))
    wanted = T.StructType.fromDDL("c_custkey bigint, detail struct<seg: string, name: string, rank: bigint>")
    shaped = structs.conform_frame(table(spark, sf, "customer").select(detail.alias("detail"), "c_custkey"), wanted)
    return shaped.select("c_custkey", F.col("detail").isNull().alias("no_detail"), "detail.*").toDF(
        "c_custkey", "no_detail", "first_field", "second_field", "third_field"
    )


@demo(
    """
    SELECT o_orderkey AS order_key, o_custkey AS order_customer_key, o_totalprice AS order_customer_paid,
           o_orderdate AS day
    FROM orders
    """
)
def struct_flatten(spark, sf):
    customer = F.struct(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("paid")).alias("customer")
    nested = table(spark, sf, "orders").select(
        F.struct(F.col("o_orderkey").alias("key"), customer).alias("order"), F.col("o_orderdate").alias("day")
    )
    flat = structs.flatten(nested)
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


@demo("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer")
def struct_nest(spark, sf):
    flat = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("who.name"),
        F.col("c_mktsegment").alias("who.market.segment"),
        F.col("c_nationkey").alias("who.market.nation"),
    )
    return structs.nest(flat).select("id", "who.name", "who.market.segment", "who.market.nation")


# -- joins ------------------------------------------------------------------------------------------------------


@demo(
    """
    SELECT l_orderkey AS from_field FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
    """
)
def join_relationships(spark, sf):
    parents = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return quality.relationships(table(spark, sf, "lineitem"), "l_orderkey", parents, "o_orderkey")


@demo(
    """
    WITH l AS (SELECT nullif(l_returnflag, 'A') AS flag, l_linestatus AS status, l_quantity FROM lineitem),
         g AS (SELECT flag, status, max(l_quantity) AS top FROM l GROUP BY flag, status)
    SELECT l.flag, l.status, count(*) AS lines, CAST(count_if(l.l_quantity = g.top) AS BIGINT) AS at_top
    FROM l JOIN g ON l.flag IS NOT DISTINCT FROM g.flag AND l.status = g.status
    GROUP BY l.flag, l.status
    """
)
def join_composite_null_safe(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.expr("nullif(l_returnflag, 'A')").alias("flag"), F.col("l_linestatus").alias("status"), "l_quantity"
    )
    tops = lines.groupBy("flag", "status").agg(F.max("l_quantity").alias("top"))
    joined = lines.alias("l").join(tops.alias("g"), key_match("l", "g", ["flag", "status"], null_safe=True))
    return joined.groupBy("l.flag", "l.status").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_quantity") == F.col("top")).alias("at_top")
    )


# -- set operations and comparison ------------------------------------------------------------------------------


@demo(
    """
    SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000
    """
)
def set_except(spark, sf):
    large = table(spark, sf, "orders").filter("o_totalprice > 300000").select("o_custkey")
    return compare.except_rows(table(spark, sf, "customer").select("c_custkey"), large)


@demo(
    """
    SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
    INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'
    """
)
def set_intersect(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    urgent, low = (orders.filter(F.col("o_orderpriority") == p).select("o_custkey") for p in ("1-URGENT", "5-LOW"))
    return compare.intersect_rows(urgent, low)


@demo(
    """
    SELECT c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_name, s_nationkey FROM supplier
    """
)
def set_union_all(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return compare.union_all(customers, suppliers)


REPRICED = """
    WITH a AS (SELECT * FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice < 400000),
         b AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                      CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                      o_orderdate, o_orderpriority FROM orders)
"""


@demo(
    REPRICED
    + """
    SELECT (SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS row_count_difference,
           (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
             + (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS num_mismatched
    """
)
def rel_diff(spark, sf):
    orders = table(spark, sf, "orders")
    repriced = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return compare.rel_diff(
        orders.filter("o_orderstatus <> 'F' OR o_totalprice < 400000"), orders.withColumn("o_totalprice", repriced)
    )


@demo(
    """
    WITH a AS (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag <> 'R'),
         b AS (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_linestatus = 'O')
    SELECT (SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS row_count_difference,
           (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b))
             + (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS num_mismatched
    """
)
def rel_diff_multiset(spark, sf):
    lines = table(spark, sf, "lineitem")
    kept, still_open = lines.filter("l_returnflag <> 'R'"), lines.filter("l_linestatus = 'O'")
    columns = ["l_suppkey", "l_quantity"]
    return compare.rel_diff(kept.select(*columns), still_open.select(*columns), multiset=True)


# -- schema evolution -------------------------------------------------------------------------------------------


def _old_customers(spark, sf):
    """Customers as an older table kept them: no segment, an integer balance, a column the source has dropped."""
    return (
        table(spark, sf, "customer")
        .filter("c_nationkey < 10")
        .select(
            "c_custkey",
            "c_name",
            "c_nationkey",
            F.col("c_acctbal").cast("int").alias("c_acctbal"),
            F.lit("legacy").alias("c_region"),
        )
    )


def _new_customers(spark, sf):
    return table(spark, sf, "customer").filter("c_nationkey >= 10")


@demo(
    """
    SELECT 'c_mktsegment' AS column_name, 'added' AS change, CAST(NULL AS VARCHAR) AS old_type, 'string' AS new_type,
           (SELECT count(c_mktsegment) FROM customer) AS values_in_use
    UNION ALL SELECT 'c_region', 'removed', 'string', NULL, (SELECT count(*) FROM customer WHERE c_nationkey < 10)
    UNION ALL SELECT 'c_acctbal', 'retyped', 'int', 'double', (SELECT count(c_acctbal) FROM customer)
    """
)
def schema_diff(spark, sf):
    # Each difference with the number of values it concerns, one pass per side.
    source, target = table(spark, sf, "customer"), _old_customers(spark, sf)
    changes = schema.diff_frame(spark, source.schema, target.schema)

    def counts(df, side):
        filled = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n")) for c in df.columns]
        return df.agg(F.array(*filled).alias("_c")).select(F.inline("_c")).withColumn("side", F.lit(side))

    used = counts(source, "source").unionByName(counts(target, "target"))
    side = F.when(F.col("change") == "removed", "target").otherwise("source")
    return changes.withColumn("side", side).join(used, ["column_name", "side"]).select(
        "column_name", "change", "old_type", "new_type", F.col("n").alias("values_in_use")
    )


@demo(
    """
    SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey < 10
    UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey >= 10
    """
)
def schema_ignore(spark, sf):
    old = _old_customers(spark, sf).select("c_custkey", "c_name", "c_nationkey")
    return compare.union_all(*schema.reconcile(old, _new_customers(spark, sf), "ignore"))


@demo(
    """
    SELECT c_custkey, c_name, c_nationkey, CAST(trunc(c_acctbal) AS INTEGER) AS c_acctbal, 'legacy' AS c_region,
           CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_nationkey < 10
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, CAST(trunc(c_acctbal) AS INTEGER), NULL, c_mktsegment
    FROM customer WHERE c_nationkey >= 10
    """
)
def schema_append(spark, sf):
    return compare.union_all(
        *schema.reconcile(_old_customers(spark, sf), _new_customers(spark, sf), "append_new_columns")
    )


@demo(
    """
    SELECT c_custkey, c_name, c_nationkey, trunc(c_acctbal) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment
    FROM customer WHERE c_nationkey < 10
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey >= 10
    """
)
def schema_sync(spark, sf):
    return compare.union_all(
        *schema.reconcile(_old_customers(spark, sf), _new_customers(spark, sf), "sync_all_columns")
    )


@demo(
    """
    SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice END
           AS price, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderpriority END AS priority,
           CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN o_custkey END AS customer
    FROM orders
    """
)
def schema_nested_add(spark, sf):
    # The newer half has two more fields, one of them inside a nested struct, and lacks one the older half has.
    orders = table(spark, sf, "orders")
    status, price = F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")
    rank = F.struct(F.col("o_orderpriority").alias("priority"))
    old = orders.filter("o_orderdate < timestamp_ntz'1999-01-01'").select(
        "o_orderkey",
        F.struct(status, F.struct(F.col("o_custkey").alias("customer")).alias("more")).alias("detail"),
    )
    new = orders.filter("o_orderdate >= timestamp_ntz'1999-01-01'").select(
        "o_orderkey", F.struct(price, status, rank.alias("more")).alias("detail")
    )
    both = compare.union_all(*schema.reconcile(old, new, "append_new_columns"))
    return both.select("o_orderkey", "detail.status", "detail.price", "detail.more.priority", "detail.more.customer")


@demo(
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_linenumber,
           CAST(CAST(l_quantity AS DECIMAL(12, 2)) AS DOUBLE) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate
    FROM lineitem
    """
)
def schema_retype(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    retyped = schema.retype(lines, {"l_orderkey": "string", "l_quantity": "decimal(12,2)", "l_shipdate": "date"})
    return retyped.withColumn("l_quantity", F.col("l_quantity").cast("double"))


@demo(
    """
    SELECT 'not_null_l_shipdate' AS constraint_name, count(*) AS violations FROM lineitem WHERE l_shipdate IS NULL
    UNION ALL SELECT 'small_quantity', count(*) FROM lineitem WHERE NOT l_quantity < 45
    UNION ALL SELECT 'known_flag', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
    UNION ALL SELECT 'line_key_null', count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL
    UNION ALL SELECT 'line_key_repeated', (SELECT CAST(sum(n - 1) AS BIGINT) FROM
        (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
    UNION ALL SELECT 'unique_l_partkey', (SELECT CAST(sum(n - 1) AS BIGINT) FROM
        (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey HAVING count(*) > 1))
    UNION ALL SELECT 'foreign_key_l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN
        (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
    """
)
def constraint_violations(spark, sf):
    parents = table(spark, sf, "orders").filter("o_orderdate < timestamp_ntz'2000-01-01'")
    rule = schema.Constraint
    return schema.constraint_violations(
        table(spark, sf, "lineitem"),
        [
            rule("not_null", ("l_shipdate",)),
            rule("check", condition="l_quantity < 45", name="small_quantity"),
            rule("custom", condition="l_returnflag IN ('A', 'N')", name="known_flag"),
            rule("primary_key", ("l_orderkey", "l_linenumber"), name="line_key"),
            rule("unique", ("l_partkey",)),
            rule("foreign_key", ("l_orderkey",), parent=parents, parent_columns=("o_orderkey",)),
        ],
    )


# -- data tests -------------------------------------------------------------------------------------------------


@demo("SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def test_unique(spark, sf):
    return quality.unique(table(spark, sf, "lineitem"), "l_orderkey")


@demo("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NULL")
def test_not_null(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    labelled = table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    return quality.not_null(labelled, "quality", whole_rows=True)


@demo(
    """
    SELECT event_type AS value_field, count(*) AS n_records FROM events
    WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type
    """
)
def test_accepted_values(spark, sf):
    return quality.accepted_values(table(spark, sf, "events"), "event_type", ["view", "click", "purchase"])


@demo(
    """
    SELECT count(*) AS failures, count(*) <> 0 AS should_warn, count(*) <> 0 AS should_error
    FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 250)
    """
)
def test_singular(spark, sf):
    heavy = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total"))
    return quality.evaluate(heavy.filter("total > 250"))


@demo(
    """
    SELECT CAST(sum(n_records) AS BIGINT) AS failures, sum(n_records) > 100 AS should_warn,
           sum(n_records) > 1000000000 AS should_error
    FROM (SELECT l_partkey, count(*) AS n_records FROM lineitem GROUP BY l_partkey HAVING count(*) > 1)
    """
)
def test_threshold(spark, sf):
    repeated = quality.unique(table(spark, sf, "lineitem"), "l_partkey")
    return quality.evaluate(repeated, fail_calc="sum(n_records)", warn_if="> 100", error_if="> 1000000000")


@demo(
    """
    SELECT count(*) AS failures, count(*) > 5 AS should_warn, count(*) > 10 AS should_error
    FROM (SELECT 1 FROM (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) > 1) LIMIT 7)
    """
)
def test_limit(spark, sf):
    repeated = quality.unique(table(spark, sf, "lineitem"), "l_partkey")
    return quality.evaluate(repeated, warn_if="> 5", error_if="> 10", limit=7)


@demo(
    """
    SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders
    WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY o_custkey HAVING count(*) > 1
    """
)
def test_where(spark, sf):
    condition = ["o_orderstatus = 'P'", "o_orderdate >= timestamp_ntz'2000-01-01'"]
    return quality.unique(quality.tested(table(spark, sf, "orders"), condition), "o_custkey")


@demo(
    """
    SELECT 'not_null_o_custkey' AS check_name, CAST(count_if(o_custkey IS NULL) AS BIGINT) AS failures FROM orders
    UNION ALL SELECT 'accepted_values_o_orderstatus', CAST(count_if(o_orderstatus NOT IN ('F', 'O')) AS BIGINT) FROM orders
    UNION ALL SELECT 'price_in_range', CAST(count_if(NOT (o_totalprice BETWEEN 2000 AND 400000)) AS BIGINT) FROM orders
    UNION ALL SELECT 'unique_o_orderkey', (SELECT count(*) FROM
        (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
    UNION ALL SELECT 'unique_o_custkey', (SELECT count(*) FROM
        (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1))
    """
)
def test_suite_summary(spark, sf):
    check = quality.Check
    return quality.suite(
        table(spark, sf, "orders"),
        [
            check("not_null", "o_custkey"),
            check("accepted_values", "o_orderstatus", values=("F", "O")),
            check("expression", expression="o_totalprice BETWEEN 2000 AND 400000", name="price_in_range"),
            check("unique", "o_orderkey"),
            check("unique", "o_custkey"),
        ],
    )


@demo(
    """
    WITH expected AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
         actual AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_discount < 0.1 GROUP BY ALL)
    SELECT *, 'expected' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM expected EXCEPT SELECT * FROM actual)
    UNION ALL
    SELECT *, 'actual', 1 FROM (SELECT * FROM actual EXCEPT SELECT * FROM expected)
    """
)
def unit_diff(spark, sf):
    lines = table(spark, sf, "lineitem")

    def summary(df):
        return df.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))

    return quality.unit_test(actual=summary(lines.filter("l_discount < 0.1")), expected=summary(lines))


# -- freshness --------------------------------------------------------------------------------------------------

NOW = dt.datetime(2024, 2, 1, 6, 30)


@demo(
    """
    SELECT max(ts) AS max_loaded_at, TIMESTAMP '2024-02-01 06:30:00' AS snapshotted_at,
           date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 06:30:00') / 1000000.0 AS age
    FROM events WHERE event_type = 'purchase'
    """
)
def freshness_field(spark, sf):
    return freshness.by_field(table(spark, sf, "events"), "ts", NOW, where="event_type = 'purchase'")


@demo(
    """
    SELECT max(first_seen) AS max_loaded_at, TIMESTAMP '2024-02-01 06:30:00' AS snapshotted_at,
           date_diff('microsecond', max(first_seen), TIMESTAMP '2024-02-01 06:30:00') / 1000000.0 AS age
    FROM (SELECT min(ts) AS first_seen FROM events GROUP BY user_id)
    """
)
def freshness_query(spark, sf):
    first_seen = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("first_seen"))
    return freshness.by_query(first_seen.agg(F.max("first_seen")), NOW)


@demo(
    """
    WITH s AS (SELECT 'events' AS source, max(ts) AS m FROM events
               UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
               UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
               UNION ALL SELECT 'nothing', TIMESTAMP '0001-01-01')
    SELECT source, m AS max_loaded_at, TIMESTAMP '2024-02-01 06:30:00' AS snapshotted_at,
           date_diff('microsecond', m, TIMESTAMP '2024-02-01 06:30:00') / 1000000.0 AS age
    FROM s
    """
)
def freshness_many(spark, sf):
    events = table(spark, sf, "events")
    return freshness.many(
        {
            "events": freshness.by_field(events, "ts", NOW),
            "orders": freshness.by_field(table(spark, sf, "orders"), "o_orderdate", NOW),
            "lineitem": freshness.by_field(table(spark, sf, "lineitem"), "l_shipdate", NOW),
            "nothing": freshness.by_field(events, "ts", NOW, where="event_type = 'none such'"),
        }
    )


# -- whole projects ---------------------------------------------------------------------------------------------


@demo(
    """
    WITH o AS (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS latest_order,
                      count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS amount
               FROM orders GROUP BY o_custkey)
    SELECT c.c_custkey, c.c_name, n.n_name, first_order, latest_order, orders, CAST(amount AS DOUBLE) AS lifetime_value
    FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    """
)
def e2e_customer_lifetime(spark, sf):
    orders = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("latest_order"),
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("lifetime_value"),
        )
    )
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, sf, "customer")
        .join(orders, "c_custkey", "left")
        .join(nation, "c_nationkey", "left")
        .select("c_custkey", "c_name", "n_name", "first_order", "latest_order", "orders", "lifetime_value")
    )


@demo(
    """
    SELECT l_orderkey,
           CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE)
             AS a_amount,
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE)
             AS n_amount,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE)
             AS r_amount,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS amount
    FROM lineitem GROUP BY l_orderkey
    """
)
def e2e_conditional_pivot(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    by_flag = [
        F.sum(F.when(F.col("l_returnflag") == flag, price).otherwise(0)).cast("double").alias(f"{flag.lower()}_amount")
        for flag in ("A", "N", "R")
    ]
    return (
        table(spark, sf, "lineitem").groupBy("l_orderkey").agg(*by_flag, F.sum(price).cast("double").alias("amount"))
    )

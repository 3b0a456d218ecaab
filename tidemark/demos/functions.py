"""Scalar functions, aggregates, generators and user-defined functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemark.demos.registry import demo, fresh_name, table
from tidemark.functions import aggregates, arrays, dates, text, types, udf
from tidemark.operators import generate


# -- scalar functions -------------------------------------------------------------------------------------------


@demo(
    """
    SELECT d.doc_id, l.quality, l.toxic, l.quality = l.toxic AS same_plain,
           l.quality IS NOT DISTINCT FROM l.toxic AS same_null_safe
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def fn_equals_null_safe(spark, sf):
    labelled = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    a, b = F.col("quality"), F.col("toxic")
    return labelled.select(
        "doc_id",
        "quality",
        "toxic",
        types.equals(a, b).alias("same_plain"),
        types.equals(a, b, null_safe=True).alias("same_null_safe"),
    )


@demo(
    """
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_orderdate AS DATE) AS day,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS price, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS rank
    FROM orders
    """
)
def fn_cast(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        types.cast(F.col("o_orderkey"), types.STRING).alias("key_text"),
        types.cast(F.col("o_orderdate"), types.DATE).alias("day"),
        types.cast(F.col("o_totalprice"), "decimal(18,2)").alias("price"),
        types.cast(text.split_part("o_orderpriority", "-", 1), types.INTEGER).alias("rank"),
    )


@demo(
    """
    SELECT p_partkey, TRY_CAST(p_type AS BIGINT) AS type_number,
           TRY_CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_number,
           TRY_CAST(p_name AS DATE) AS name_date
    FROM part
    """
)
def fn_safe_cast(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        types.safe_cast(F.col("p_type"), types.BIGINT).alias("type_number"),
        types.safe_cast(text.split_part("p_brand", "#", 2), types.BIGINT).alias("brand_number"),
        types.safe_cast(F.col("p_name"), types.DATE).alias("name_date"),
    )


@demo(
    """
    SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN NULL WHEN l.quality = 1 THEN 'true' ELSE 'false' END AS good
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def fn_bool_to_text(spark, sf):
    labelled = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return labelled.select("doc_id", text.bool_to_text(F.col("quality") == 1).alias("good"))


@demo(
    """
    SELECT c_custkey, c_name || '/' || c_mktsegment AS label,
           c_name || CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS label_or_null
    FROM customer
    """
)
def fn_concat(spark, sf):
    rich = F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.concat("c_name", F.lit("/"), "c_mktsegment").alias("label"),
        text.concat("c_name", rich).alias("label_or_null"),
    )


@demo("SELECT doc_id, md5(text) AS text_hash, md5(CAST(doc_id AS VARCHAR)) AS id_hash FROM documents")
def fn_hash(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.hash_text("text").alias("text_hash"), text.hash_text("doc_id").alias("id_hash")
    )


@demo("SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents")
def fn_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.length("text").cast("bigint").alias("chars"))


@demo("SELECT doc_id, CAST(strpos(text, 'the') AS BIGINT) AS first_the FROM documents")
def fn_position(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.position(F.lit("the"), "text").cast("bigint").alias("first_the")
    )


@demo("SELECT doc_id, md5(replace(text, 'the', '<THE>')) AS replaced FROM documents")
def fn_replace(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.replace("text", "the", "<THE>")).alias("replaced"))


@demo("SELECT p_partkey, right(p_name, 4) AS tail, '' AS nothing FROM part")
def fn_right(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.right("p_name", 4).alias("tail"), text.right("p_name", 0).alias("nothing")
    )


@demo(
    """
    SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS last_piece,
           split_part(url, '/', 20) AS beyond
    FROM pages
    """
)
def fn_split_part(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        text.split_part("url", "/", 3).alias("host"),
        text.split_part("url", "/", -1).alias("last_piece"),
        text.split_part("url", "/", 20).alias("beyond"),
    )


@demo(
    """
    SELECT page_id, md5(replace(html, '''', '''''')) AS doubled, md5(replace(html, '''', chr(92) || '''')) AS slashed,
           'it''s' AS literal
    FROM pages
    """
)
def fn_escape_quotes(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.md5(text.escape_single_quotes("html")).alias("doubled"),
        F.md5(text.escape_single_quotes("html", "backslash")).alias("slashed"),
        text.string_literal("it's").alias("literal"),
    )


@demo(
    """
    SELECT p_partkey, p_size || ',' || (p_size + 1) AS sizes, CAST(0 AS BIGINT) AS empty_size FROM part
    """
)
def fn_array_construct(spark, sf):
    pair = arrays.array_construct([F.col("p_size"), F.col("p_size") + 1])
    return table(spark, sf, "part").select(
        "p_partkey",
        F.array_join(pair.cast("array<string>"), ",").alias("sizes"),
        F.size(arrays.array_construct([], "int")).cast("bigint").alias("empty_size"),
    )


@demo("SELECT p_partkey, p_brand || ',' || p_type || ',' || p_name AS words FROM part")
def fn_array_append(spark, sf):
    pair = arrays.array_construct([F.col("p_brand"), F.col("p_type")])
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(arrays.array_append(pair, F.col("p_name")), ",").alias("words")
    )


@demo(
    """
    SELECT vec_id, CAST(i AS INTEGER) AS place, CAST(twice[i + 1] AS DOUBLE) AS value
    FROM (SELECT vec_id, list_concat(embedding, embedding) AS twice, unnest(range(2 * len(embedding))) AS i
          FROM embeddings)
    """
)
def fn_array_concat(spark, sf):
    twice = arrays.array_concat(F.col("embedding"), F.col("embedding"))
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(twice.cast("array<double>")).alias("place", "value"))


@demo(
    """
    SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start,
           DATE '1999-12-31' AS fixed_day
    FROM orders
    """
)
def fn_date(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.make_date(F.year(day), F.month(day), 1).alias("month_start"),
        dates.make_date(1999, 12, 31).alias("fixed_day"),
    )


@demo(
    """
    SELECT event_id,
           date_trunc('minute', ts)::TIMESTAMP AS t_minute, date_trunc('hour', ts)::TIMESTAMP AS t_hour,
           date_trunc('day', ts)::TIMESTAMP AS t_day, date_trunc('week', ts)::TIMESTAMP AS t_week,
           date_trunc('month', ts)::TIMESTAMP AS t_month, date_trunc('quarter', ts)::TIMESTAMP AS t_quarter,
           date_trunc('year', ts)::TIMESTAMP AS t_year
    FROM events
    """
)
def fn_date_trunc(spark, sf):
    parts = ["minute", "hour", "day", "week", "month", "quarter", "year"]
    return table(spark, sf, "events").select(
        "event_id", *[dates.date_trunc(p, F.col("ts")).alias(f"t_{p}") for p in parts]
    )


@demo(
    """
    SELECT event_id, ts + INTERVAL 1 DAY AS next_day, ts + INTERVAL 1 MONTH AS next_month,
           ts - INTERVAL 1 YEAR AS last_year, ts + INTERVAL 36 HOUR AS hours_on,
           ts + INTERVAL 250 MILLISECOND AS millis_on, ts + INTERVAL 3 MONTH AS next_quarter
    FROM events
    """
)
def fn_dateadd(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        dates.dateadd("day", 1, ts).alias("next_day"),
        dates.dateadd("month", 1, ts).alias("next_month"),
        dates.dateadd("year", -1, ts).alias("last_year"),
        dates.dateadd("hour", 36, ts).alias("hours_on"),
        dates.dateadd("millisecond", 250, ts).alias("millis_on"),
        dates.dateadd("quarter", 1, ts).alias("next_quarter"),
    )


def _line_delays(spark, sf):
    """Every line with its order's date (one shuffle by order key, or a broadcast of small orders)."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lines.join(orders, "l_orderkey")


@demo(
    """
    SELECT l_orderkey, l_linenumber, date_diff('day', o_orderdate, l_shipdate) AS days
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """
)
def fn_datediff_day(spark, sf):
    days = dates.datediff(F.col("o_orderdate"), F.col("l_shipdate"), "day")
    return _line_delays(spark, sf).select("l_orderkey", "l_linenumber", days.alias("days"))


@demo(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(floor((date_diff('day', TIMESTAMP '1970-01-01', l_shipdate) + 4) / 7.0)
              - floor((date_diff('day', TIMESTAMP '1970-01-01', o_orderdate) + 4) / 7.0) AS BIGINT) AS weeks
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """
)
def fn_datediff_week(spark, sf):
    weeks = dates.datediff(F.col("o_orderdate"), F.col("l_shipdate"), "week")
    return _line_delays(spark, sf).select("l_orderkey", "l_linenumber", weeks.alias("weeks"))


@demo(
    """
    SELECT l_orderkey, l_linenumber, date_diff('month', o_orderdate, l_shipdate) AS months,
           date_diff('quarter', o_orderdate, l_shipdate) AS quarters, date_diff('year', o_orderdate, l_shipdate) AS years
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """
)
def fn_datediff_month(spark, sf):
    a, b = F.col("o_orderdate"), F.col("l_shipdate")
    return _line_delays(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        *[dates.datediff(a, b, part).alias(f"{part}s") for part in ("month", "quarter", "year")],
    )


@demo(
    """
    SELECT event_id, date_diff('hour', TIMESTAMP '2024-01-15 12:30:00', ts) AS hours,
           date_diff('minute', TIMESTAMP '2024-01-15 12:30:00', ts) AS minutes,
           date_diff('second', TIMESTAMP '2024-01-15 12:30:00', ts) AS seconds,
           date_diff('millisecond', TIMESTAMP '2024-01-15 12:30:00', ts) AS milliseconds
    FROM events
    """
)
def fn_datediff_hour(spark, sf):
    noon = F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        "event_id",
        *[
            dates.datediff(noon, F.col("ts"), part).alias(f"{part}s")
            for part in ("hour", "minute", "second", "millisecond")
        ],
    )


@demo(
    """
    SELECT o_orderkey, last_day(o_orderdate) AS month_end,
           CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
           CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end
    FROM orders
    """
)
def fn_last_day(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        *[dates.last_day(F.col("o_orderdate"), part).alias(f"{part}_end") for part in ("month", "quarter", "year")],
    )


@demo(
    """
    SELECT l_linestatus AS v_string, l_shipdate AS v_timestamp, l_quantity AS v_float,
           CAST(CAST(l_extendedprice AS DECIMAL(28, 6)) AS DOUBLE) AS v_numeric, l_orderkey AS v_bigint,
           l_linenumber AS v_integer, l_tax > 0 AS v_boolean, CAST(l_shipdate AS DATE) AS v_date
    FROM lineitem
    """
)
def fn_types(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_linestatus").cast(types.STRING).alias("v_string"),
        F.col("l_shipdate").cast(types.TIMESTAMP).alias("v_timestamp"),
        F.col("l_quantity").cast(types.FLOAT).alias("v_float"),
        F.col("l_extendedprice").cast(types.NUMERIC).cast(types.FLOAT).alias("v_numeric"),
        F.col("l_orderkey").cast(types.BIGINT).alias("v_bigint"),
        F.col("l_linenumber").cast(types.INTEGER).alias("v_integer"),
        (F.col("l_tax") > 0).cast(types.BOOLEAN).alias("v_boolean"),
        F.col("l_shipdate").cast(types.DATE).alias("v_date"),
    )


@demo(
    "SELECT c_custkey, left(c_name, 2) || repeat('*', length(c_name) - 2) AS masked FROM customer"
)
def fn_mask_pii(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.mask_tail("c_name").alias("masked"))


# -- aggregates -------------------------------------------------------------------------------------------------


@demo(
    """
    SELECT c_nationkey, min(c_mktsegment) AS a_segment, min(n_name) AS nation_name, count(*) AS customers
    FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY c_nationkey
    """
)
def agg_any_value(spark, sf):
    # Every row of a group has the same nation name, so any value will do; the segments differ.
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, sf, "customer")
        .join(nation, "c_nationkey")
        .groupBy("c_nationkey")
        .agg(
            aggregates.any_value(F.col("c_mktsegment"), deterministic=True).alias("a_segment"),
            aggregates.any_value(F.col("n_name")).alias("nation_name"),
            F.count(F.lit(1)).alias("customers"),
        )
    )


@demo(
    """
    SELECT o_custkey, bool_or(o_orderstatus = 'P') AS any_pending,
           bool_or(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice > 450000 END) AS any_large
    FROM orders GROUP BY o_custkey
    """
)
def agg_bool_or(spark, sf):
    large = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") > 450000)
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            aggregates.bool_or(F.col("o_orderstatus") == "P").alias("any_pending"),
            aggregates.bool_or(large).alias("any_large"),
        )
    )


@demo(
    """
    SELECT user_id, string_agg(event_type, '_|_' ORDER BY ts, event_id) AS path FROM events GROUP BY user_id
    """
)
def agg_listagg(spark, sf):
    return aggregates.listagg(
        table(spark, sf, "events"),
        ["user_id"],
        F.col("event_type"),
        delimiter="_|_",
        order_by=F.struct("ts", "event_id"),
        alias="path",
    )


@demo(
    """
    SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY place) AS top_orders
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
          FROM orders)
    WHERE place <= 3 GROUP BY o_custkey
    """
)
def agg_listagg_topn(spark, sf):
    return aggregates.listagg(
        table(spark, sf, "orders"),
        ["o_custkey"],
        F.col("o_orderkey"),
        order_by=F.struct(-F.col("o_totalprice"), F.col("o_orderkey")),
        limit=3,
        alias="top_orders",
    )


@demo(
    """
    SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
    FROM orders GROUP BY o_custkey
    """
)
def agg_listagg_distinct(spark, sf):
    return aggregates.listagg(
        table(spark, sf, "orders"),
        ["o_custkey"],
        F.col("o_orderpriority"),
        delimiter=", ",
        distinct=True,
        alias="priorities",
    )


@demo(
    """
    SELECT c_nationkey,
           CAST(coalesce(sum(CASE WHEN c_acctbal > 5000 THEN CAST(c_acctbal - 5000 AS DECIMAL(18, 2)) END), 0) AS DOUBLE)
             AS above
    FROM customer GROUP BY c_nationkey
    """
)
def agg_sum_positive(spark, sf):
    above = (F.col("c_acctbal") - 5000).cast("decimal(18,2)")
    return (
        table(spark, sf, "customer")
        .groupBy("c_nationkey")
        .agg(aggregates.sum_positive(above).cast("double").alias("above"))
    )


# -- generators -------------------------------------------------------------------------------------------------


@demo(
    """
    SELECT g.n AS generated_number, o.o_orderkey IS NOT NULL AS used
    FROM (SELECT unnest(range(1, (SELECT max(o_orderkey) + 1 FROM orders))) AS n) g
    LEFT JOIN orders o ON o.o_orderkey = g.n
    """
)
def gen_series(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    series = generate.generate_series(spark, top)
    used = orders.withColumn("_used", F.lit(True))
    return series.join(used, series["generated_number"] == used["o_orderkey"], "left").select(
        "generated_number", F.coalesce("_used", F.lit(False)).alias("used")
    )


def _bounds(frame, column):
    row = frame.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return row["low"], row["high"]


@demo(
    """
    SELECT d AS date_day
    FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
                                        (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)
    WHERE d < (SELECT max(o_orderdate) FROM orders)
    """
)
def gen_date_spine(spark, sf):
    low, high = _bounds(table(spark, sf, "orders"), "o_orderdate")
    return generate.date_spine(spark, "day", low, high)


@demo(
    """
    SELECT d AS date_month
    FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders)::TIMESTAMP,
                                        (SELECT max(o_orderdate) FROM orders), INTERVAL 1 MONTH)) AS d)
    WHERE d < (SELECT date_trunc('month', max(o_orderdate)) FROM orders)
    """
)
def gen_date_spine_month(spark, sf):
    low, high = _bounds(table(spark, sf, "orders"), "o_orderdate")
    return generate.date_spine(spark, "month", low.replace(day=1), high)


@demo(
    """
    SELECT strftime(d, '%Y%m%d') AS date_text
    FROM (SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events)::TIMESTAMP,
                                        (SELECT CAST(max(ts) AS DATE) FROM events)::TIMESTAMP, INTERVAL 1 DAY)) AS d)
    """
)
def gen_dates_in_range(spark, sf):
    low, high = _bounds(table(spark, sf, "events"), "ts")
    return generate.partition_range(spark, f"{low:%Y%m%d},{high:%Y%m%d}")


@demo(
    """
    WITH spine AS (
      SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events)::TIMESTAMP,
                                    (SELECT max(ts) FROM events), INTERVAL 1 HOUR)) AS date_hour),
    facts AS (
      SELECT date_trunc('hour', ts) AS h, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT date_hour, f.errors FROM spine LEFT JOIN facts f ON f.h = date_hour
    WHERE date_hour < (SELECT date_trunc('hour', max(ts)) FROM events)
    """
)
def spine_fill(spark, sf):
    events = table(spark, sf, "events")
    low, high = _bounds(events, "ts")
    spine = generate.date_spine(spark, "hour", low.replace(minute=0, second=0, microsecond=0), high)
    errors = events.filter(F.col("event_type") == "error")
    return generate.fill_gaps(spine, errors, "hour", "ts", {"errors": F.count(F.lit(1))})


# -- user-defined functions -------------------------------------------------------------------------------------


@demo("SELECT p_partkey, p_retailprice * 2 AS doubled FROM part")
def udf_sql_scalar(spark, sf):
    name = udf.create_sql_function(
        spark, fresh_name("doubled_price"), [udf.Arg("price", "DOUBLE")], "DOUBLE", "price * 2"
    )
    return table(spark, sf, "part").select("p_partkey", F.call_function(name, "p_retailprice").alias("doubled"))


@demo("SELECT p_partkey, p_retailprice + p_size AS sized, p_retailprice + 100 AS plain FROM part")
def udf_sql_default(spark, sf):
    name = udf.create_sql_function(
        spark,
        fresh_name("with_surcharge"),
        [udf.Arg("price", "DOUBLE"), udf.Arg("surcharge", "DOUBLE", default="100")],
        "DOUBLE",
        "price + surcharge",
    )
    return table(spark, sf, "part").select(
        "p_partkey",
        F.call_function(name, F.col("p_retailprice"), F.col("p_size").cast("double")).alias("sized"),
        F.expr(f"{name}(p_retailprice)").alias("plain"),
    )


def _net_price(price: pd.Series, discount: pd.Series) -> pd.Series:
    return price * (1 - discount)


@demo(
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem"
)
def udf_py_scalar(spark, sf):
    net = udf.create_python_function(spark, fresh_name("net_price"), _net_price, "double")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", net("l_extendedprice", "l_discount").alias("net")
    )


@demo("SELECT l_returnflag, pow(sum(l_quantity), 2) AS sum_squared FROM lineitem GROUP BY l_returnflag")
def udaf_sql_sum_squared(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.groupBy("l_returnflag").agg(aggregates.sum_squared(F.col("l_quantity")).alias("sum_squared"))


@demo(
    """
    SELECT l_suppkey, l_returnflag, pow(sum(l_quantity), 2) AS sum_squared
    FROM lineitem GROUP BY l_suppkey, l_returnflag
    """
)
def udaf_py_sum_squared(spark, sf):
    return udf.aggregate(
        table(spark, sf, "lineitem"),
        ["l_suppkey", "l_returnflag"],
        "l_quantity",
        udf.SumSquared(),
        "double",
        "sum_squared",
    )

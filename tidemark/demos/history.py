"""Type-2 history over orders and customers.

The first look at the orders misses those placed from 2001 on.  The second has them, has lost the early finished ones,
and shows every pending order changed a month later.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.demos.registry import demo, table
from tidemark.functions.dates import as_time, dateadd
from tidemark.operators import history as hist

FIRST, SECOND, THIRD = dt.datetime(2002, 1, 1), dt.datetime(2002, 6, 1, 8, 15), dt.datetime(2003, 3, 1)
BACK = dt.datetime(2003, 2, 1)
FAR = dt.datetime(9999, 12, 31)

COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
LOST = "o_orderstatus = 'F' AND o_orderdate < {ts}'1996-01-01'"


def _first_look(spark, sf):
    return table(spark, sf, "orders").select(*COLUMNS).filter("o_orderdate < timestamp_ntz'2001-01-01'")


def _second_look(spark, sf):
    orders = table(spark, sf, "orders").select(*COLUMNS)
    pending = F.col("o_orderstatus") == "P"
    return orders.filter(f"NOT ({LOST.format(ts='timestamp_ntz')})").withColumns(
        {
            "o_totalprice": F.when(pending, F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice")),
            "o_orderdate": F.when(pending, dateadd("day", 30, F.col("o_orderdate"))).otherwise(F.col("o_orderdate")),
        }
    )


#: The two looks in SQL.
LOOKS = f"""
    WITH s0 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
                WHERE o_orderdate < TIMESTAMP '2001-01-01'),
         s1 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                       CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
                       CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END
                         AS o_orderdate
                FROM orders WHERE NOT ({LOST.format(ts="TIMESTAMP ")}))
"""


def _versions(relation: str, key: str, updated_at: str, extra: str = "", valid_to: str = "CAST(NULL AS TIMESTAMP)"):
    """SQL of freshly built versions of a relation's rows."""
    keys = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in key.split())
    return f"""
        SELECT *, md5({keys} || '|' || strftime({updated_at}, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
               {updated_at} AS scd_updated_at, {updated_at} AS valid_from, {valid_to} AS valid_to {extra}
        FROM {relation}
    """


def _moment(when: dt.datetime) -> str:
    return f"TIMESTAMP '{when:%Y-%m-%d %H:%M:%S}'"


@demo(
    f"""
    SELECT * FROM ({_versions('(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders) o',
                              'o_orderkey', 'o_orderdate')})
    """
)
def scd_init(spark, sf):
    cfg = hist.Snapshot("o_orderkey", hist.timestamp_strategy("o_orderdate"))
    return hist.first_build(table(spark, sf, "orders").select(*COLUMNS), cfg, FIRST)


#: Old and new versions under the timestamp strategy; {gone} is the end of versions whose key is lost.
TIMESTAMP_SQL = f"""
    , h0 AS ({_versions('s0', 'o_orderkey', 'o_orderdate', extra='{extra}', valid_to='{open}')}),
      v1 AS ({_versions('s1', 'o_orderkey', 'o_orderdate', extra='{extra}', valid_to='{open}')}),
      result AS (
        SELECT h0.* REPLACE (CASE WHEN v1.o_orderkey IS NULL THEN {{gone}} WHEN v1.o_orderdate > h0.valid_from
                                  THEN v1.o_orderdate ELSE h0.valid_to END AS valid_to)
        FROM h0 LEFT JOIN v1 ON v1.o_orderkey = h0.o_orderkey
        UNION ALL
        SELECT v1.* FROM v1 LEFT JOIN h0 ON v1.o_orderkey = h0.o_orderkey
        WHERE h0.o_orderkey IS NULL OR v1.o_orderdate > h0.valid_from)
"""


def _timestamp_sql(gone="h0.valid_to", extra="", still_open="CAST(NULL AS TIMESTAMP)"):
    filled = TIMESTAMP_SQL.replace("{extra}", extra).replace("{open}", still_open).replace("{{gone}}", gone)
    return LOOKS + filled.replace("{gone}", gone)


def _two_looks(spark, sf, **settings):
    cfg = hist.Snapshot("o_orderkey", hist.timestamp_strategy("o_orderdate"), **settings)
    return hist.apply(hist.first_build(_first_look(spark, sf), cfg, FIRST), _second_look(spark, sf), cfg, SECOND), cfg


@demo(_timestamp_sql() + "SELECT * FROM result")
def scd_timestamp(spark, sf):
    return _two_looks(spark, sf)[0]


@demo(_timestamp_sql(gone=_moment(SECOND)) + "SELECT * FROM result")
def scd_invalidate(spark, sf):
    return _two_looks(spark, sf, hard_deletes="invalidate")[0]


DELETED_SQL = _timestamp_sql(gone=_moment(SECOND), extra=", 'False' AS is_deleted") + f"""
    , markers AS (
        SELECT h0.* REPLACE (md5(h0.scd_id || '|' || strftime({_moment(SECOND)}, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
                             {_moment(SECOND)} AS scd_updated_at, {_moment(SECOND)} AS valid_from,
                             'True' AS is_deleted)
        FROM h0 WHERE h0.o_orderkey NOT IN (SELECT o_orderkey FROM s1))
"""


@demo(DELETED_SQL + "SELECT * FROM result UNION ALL SELECT * FROM markers")
def scd_new_record(spark, sf):
    return _two_looks(spark, sf, hard_deletes="new_record")[0]


@demo(
    DELETED_SQL
    + f"""
    , back AS (SELECT * REPLACE ({_moment(BACK)} AS o_orderdate)
               FROM s0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s1))
    SELECT * FROM result
    UNION ALL SELECT * REPLACE ({_moment(BACK)} AS valid_to) FROM markers
    UNION ALL {_versions('back', 'o_orderkey', 'o_orderdate', extra=", 'False' AS is_deleted")}
    """
)
def scd_reappear(spark, sf):
    # The lost orders are back: the version saying 'deleted' is closed, and a live one opens.
    history, cfg = _two_looks(spark, sf, hard_deletes="new_record")
    lost = _first_look(spark, sf).filter(LOST.format(ts="timestamp_ntz"))
    third = _second_look(spark, sf).unionByName(lost.withColumn("o_orderdate", as_time(BACK)))
    return hist.apply(history, third, cfg, THIRD)


@demo(_timestamp_sql(still_open=_moment(FAR)) + "SELECT * FROM result")
def scd_valid_to_current(spark, sf):
    return _two_looks(spark, sf, current_value=FAR)[0]


@demo(
    LOOKS
    + f"""
    , h0 AS ({_versions('s0', 'o_orderkey', _moment(FIRST))}), v1 AS ({_versions('s1', 'o_orderkey', _moment(SECOND))})
    SELECT h0.* REPLACE (CASE WHEN v1.o_totalprice <> h0.o_totalprice THEN {_moment(SECOND)} END AS valid_to)
    FROM h0 LEFT JOIN v1 ON v1.o_orderkey = h0.o_orderkey
    UNION ALL
    SELECT v1.* FROM v1 LEFT JOIN h0 ON v1.o_orderkey = h0.o_orderkey
    WHERE h0.o_orderkey IS NULL OR v1.o_totalprice <> h0.o_totalprice
    """
)
def scd_check(spark, sf):
    cfg = hist.Snapshot("o_orderkey", hist.check_strategy(["o_totalprice"]))
    return hist.apply(hist.first_build(_first_look(spark, sf), cfg, FIRST), _second_look(spark, sf), cfg, SECOND)


#: Two more looks at the orders: prices go up for one kind of orders, and down for another.
PRICES = f"""
    WITH s0 AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders),
         s1 AS (SELECT o_orderkey, o_orderstatus, o_totalprice + CASE o_orderstatus WHEN 'P' THEN 100 WHEN 'F' THEN -100 ELSE 10 END
                  AS o_totalprice FROM orders),
         h0 AS ({_versions('s0', 'o_orderkey', _moment(FIRST))}), v1 AS ({_versions('s1', 'o_orderkey', _moment(SECOND))})
"""


@demo(
    PRICES
    + f"""
    SELECT h0.* REPLACE (CASE WHEN v1.o_totalprice > h0.o_totalprice + 50 THEN {_moment(SECOND)} END AS valid_to)
    FROM h0 JOIN v1 ON v1.o_orderkey = h0.o_orderkey
    UNION ALL
    SELECT v1.* FROM v1 JOIN h0 ON v1.o_orderkey = h0.o_orderkey WHERE v1.o_totalprice > h0.o_totalprice + 50
    """
)
def scd_own_strategy(spark, sf):
    # A strategy of the user's own: only a price that is up by more than 50 is a change.
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")

    def dearer(source, history, cfg):
        return F.col("src.o_totalprice") > F.col("cur.o_totalprice") + 50

    rise = F.when(F.col("o_orderstatus") == "P", 100).when(F.col("o_orderstatus") == "F", -100).otherwise(10)
    cfg = hist.Snapshot("o_orderkey", hist.Strategy(None, dearer))
    second = orders.withColumn("o_totalprice", F.col("o_totalprice") + rise)
    return hist.apply(hist.first_build(orders, cfg, FIRST), second, cfg, SECOND)


@demo(
    f"""
    WITH s0 AS (SELECT * REPLACE (nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment) FROM customer),
         s1 AS (SELECT * REPLACE (nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment) FROM customer),
         h0 AS ({_versions('s0', 'c_custkey', _moment(FIRST))}), v1 AS ({_versions('s1', 'c_custkey', _moment(SECOND))})
    SELECT h0.* REPLACE (CASE WHEN v1.c_mktsegment IS DISTINCT FROM h0.c_mktsegment THEN {_moment(SECOND)} END
                         AS valid_to)
    FROM h0 JOIN v1 ON v1.c_custkey = h0.c_custkey
    UNION ALL
    SELECT v1.* FROM v1 JOIN h0 ON v1.c_custkey = h0.c_custkey WHERE v1.c_mktsegment IS DISTINCT FROM h0.c_mktsegment
    """
)
def scd_check_all(spark, sf):
    # One segment becomes known, another unknown: values turning null, or back, are changes too.
    customers = table(spark, sf, "customer")
    cfg = hist.Snapshot("c_custkey", hist.check_strategy("all"))

    def without(segment):
        return customers.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit(segment)))

    return hist.apply(hist.first_build(without("MACHINERY"), cfg, FIRST), without("HOUSEHOLD"), cfg, SECOND)


@demo(
    f"""
    WITH s0 AS (SELECT c_custkey, c_name FROM customer), s1 AS (SELECT c_custkey, c_name, c_mktsegment FROM customer)
    SELECT c_custkey, c_name, scd_id, scd_updated_at, valid_from, {_moment(SECOND)} AS valid_to,
           CAST(NULL AS VARCHAR) AS c_mktsegment FROM ({_versions('s0', 'c_custkey', _moment(FIRST))})
    UNION ALL
    SELECT c_custkey, c_name, scd_id, scd_updated_at, valid_from, valid_to, c_mktsegment
    FROM ({_versions('s1', 'c_custkey', _moment(SECOND))})
    """
)
def scd_check_new_column(spark, sf):
    # The history never had the newly checked column: every row gets a new version.
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    cfg = hist.Snapshot("c_custkey", hist.check_strategy(["c_name", "c_mktsegment"]))
    history = hist.first_build(customers.drop("c_mktsegment"), cfg, FIRST)
    return hist.apply(history, customers, cfg, SECOND)


@demo(
    LOOKS
    + f"""
    , a0 AS (SELECT o_custkey, o_orderstatus, count(*) AS n, max(o_orderdate) AS last_order FROM s0 GROUP BY ALL),
      a1 AS (SELECT o_custkey, o_orderstatus, count(*) AS n, max(o_orderdate) AS last_order FROM s1 GROUP BY ALL),
      h0 AS ({_versions('a0', 'o_custkey o_orderstatus', 'last_order')}),
      v1 AS ({_versions('a1', 'o_custkey o_orderstatus', 'last_order')})
    SELECT h0.* REPLACE (CASE WHEN v1.last_order > h0.valid_from THEN v1.last_order END AS valid_to)
    FROM h0 LEFT JOIN v1 ON v1.o_custkey = h0.o_custkey AND v1.o_orderstatus = h0.o_orderstatus
    UNION ALL
    SELECT v1.* FROM v1 LEFT JOIN h0 ON v1.o_custkey = h0.o_custkey AND v1.o_orderstatus = h0.o_orderstatus
    WHERE h0.o_custkey IS NULL OR v1.last_order > h0.valid_from
    """
)
def scd_composite(spark, sf):
    key = ["o_custkey", "o_orderstatus"]

    def summary(df):
        return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last_order"))

    cfg = hist.Snapshot(key, hist.timestamp_strategy("last_order"))
    history = hist.first_build(summary(_first_look(spark, sf)), cfg, FIRST)
    return hist.apply(history, summary(_second_look(spark, sf)), cfg, SECOND)


@demo(
    _timestamp_sql()
    + """
    SELECT o_orderkey, CASE WHEN old THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, scd_id,
           scd_updated_at, valid_from, valid_to, CASE WHEN NOT old THEN o_orderstatus || '!' END AS o_note
    FROM (SELECT r.*, r.scd_id IN (SELECT scd_id FROM h0) AS old FROM result r)
    """
)
def scd_new_source_column(spark, sf):
    # The source gained o_note and lost o_custkey; the history keeps both.
    cfg = hist.Snapshot("o_orderkey", hist.timestamp_strategy("o_orderdate"))
    second = _second_look(spark, sf).withColumn("o_note", F.concat("o_orderstatus", F.lit("!"))).drop("o_custkey")
    return hist.apply(hist.first_build(_first_look(spark, sf), cfg, FIRST), second, cfg, SECOND)

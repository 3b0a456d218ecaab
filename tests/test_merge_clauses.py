"""Merges that also decide on what the batch lacks, and keys that must be unique in the whole table."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.keys import probably_among
from tidemark.operators.merge import merge
from tidemark.operators.schema import Constraint, SchemaMismatch
from tidemark.plans import load as loading
from tidemark.plans.load import Load, load, load_in_parts, load_microbatches

SCHEMA = "id int, v string, p int"


def frame(spark, *found, schema=SCHEMA):
    return spark.createDataFrame(list(found), schema)


OLD = [(1, "a", 0), (2, "b", 0), (3, "c", 1), (4, "d", 1), (None, "n", 0)]


# -- not matched by source ----------------------------------------------------------------------------------------


def test_rows_the_batch_lacks_are_deleted(spark):
    old, new = frame(spark, *OLD), frame(spark, (1, "A", 0), (9, "z", 1), (None, "m", 0))
    assert rows(merge(old, new, "id", by_source="delete")) == [(1, "A", 0), (9, "z", 1), (None, "m", 0)]
    within = merge(old, new, "id", by_source="delete", by_source_condition="target.p = 0")
    assert rows(within) == [(1, "A", 0), (3, "c", 1), (4, "d", 1), (9, "z", 1), (None, "m", 0)]


def test_rows_the_batch_lacks_are_updated(spark):
    old, new = frame(spark, *OLD), frame(spark, (1, "A", 0), (9, "z", 1))
    got = merge(old, new, "id", by_source={"v": "concat(target.v, '!')"}, by_source_condition=F.col("target.p") == 0)
    assert rows(got) == [(1, "A", 0), (2, "b!", 0), (3, "c", 1), (4, "d", 1), (9, "z", 1), (None, "n!", 0)]
    with pytest.raises(ValueError):
        merge(old, new, "id", by_source={"nope": "1"})
    with pytest.raises(ValueError):
        merge(old, new, "id", by_source="drop")


def test_rows_outside_the_predicates_are_not_matched_by_source(spark):
    old, new = frame(spark, *OLD), frame(spark, (1, "A", 0), (3, "C", 1))
    got = merge(old, new, "id", predicates="target.p = 0", by_source="delete")
    assert rows(got) == [(1, "A", 0), (3, "C", 1)]
    # 3 is outside the predicates: not matched, so it goes and the batch's row comes; a null condition keeps rows.
    kept = merge(old, new, "id", predicates="target.p = 0", by_source="delete", by_source_condition="target.id > 2")
    assert rows(kept) == [(1, "A", 0), (2, "b", 0), (3, "C", 1), (None, "n", 0)]


def test_other_clauses_go_on_as_before(spark):
    old, new = frame(spark, *OLD), frame(spark, (1, "A", 0), (2, "B", 0), (3, "C", 1))
    got = merge(
        old, new, "id", delete_condition="batch.v = 'B'", update_condition="batch.v <> 'C'",
        by_source="delete", by_source_condition="target.id is not null",
    )
    assert rows(got) == [(1, "A", 0), (3, "c", 1), (None, "n", 0)]


def test_hot_keys_and_empty_sides(spark):
    hot = spark.range(2000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id").cast("int")).alias("id"), F.lit("x").alias("v"), F.lit(0).alias("p"))
    got = merge(hot, frame(spark, (7, "y", 0)), "id", by_source="delete")
    assert got.count() == 1500 and rows(got.select("v").distinct()) == [("y",)]
    assert merge(hot, frame(spark), "id", by_source="delete").count() == 0
    assert merge(hot.limit(0), frame(spark, (7, "y", 0)), "id", by_source="delete").count() == 1


@pytest.mark.parametrize("by", [[], ["p"]])
def test_tables_follow_a_whole_source(spark, name, by):
    """Every load brings the table to what the source holds, wherever the rows are kept."""
    cfg = Load(unique_key="id", partition_by=by, by_source="delete")
    load(frame(spark, *OLD[:4]), name, cfg)
    load(frame(spark, (1, "A", 0), (8, "h", 5)), name, cfg)
    assert rows(spark.table(name)) == [(1, "A", 0), (8, "h", 5)]
    part = Load(unique_key="id", partition_by=by, by_source={"v": "'gone'"}, by_source_condition="target.p = 5")
    load(frame(spark, (1, "AA", 0)), name, part)
    assert rows(spark.table(name)) == [(1, "AA", 0), (8, "gone", 5)]
    if by:
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    load(frame(spark), name, cfg)
    assert spark.table(name).count() == 0


def test_by_source_needs_a_merge(spark):
    for bad in (Load(strategy="append", by_source="delete"), Load(strategy="delete+insert", unique_key="id", by_source="delete")):
        with pytest.raises(ValueError):
            loading.validate(bad)
    with pytest.raises(ValueError):
        loading.validate(Load(unique_key="id", by_source_condition="target.p = 1"))


# -- keys across the table ----------------------------------------------------------------------------------------

UNIQUE = [Constraint("unique", ("id",))]


def refused(spark, batch, name, cfg):
    before = rows(spark.table(name))
    with pytest.raises(SchemaMismatch, match="unique_id"):
        load(batch, name, cfg)
    assert rows(spark.table(name)) == before  # nothing was written


@pytest.mark.parametrize("by", [[], ["p"]])
def test_an_append_may_not_repeat_a_key_of_the_table(spark, name, by):
    cfg = Load(strategy="append", partition_by=by, constraints=UNIQUE)
    load(frame(spark, *OLD[:4]), name, cfg)
    refused(spark, frame(spark, (5, "e", 0), (3, "again", 2)), name, cfg)
    load(frame(spark, (5, "e", 0), (None, "m", 0), (None, "o", 0)), name, cfg)  # nulls are no keys
    assert spark.table(name).count() == 7


def test_a_merge_may_update_but_not_double(spark, name):
    by_id = Load(unique_key="id", constraints=UNIQUE, partition_by=["p"])
    load(frame(spark, *OLD[:4]), name, by_id)
    load(frame(spark, (3, "C", 0), (6, "f", 1)), name, by_id)  # matched rows are replaced
    assert rows(spark.table(name).filter("id = 3")) == [(3, "C", 0)]
    refused(spark, frame(spark, (1, "other v", 7)), name, Load(unique_key="v", constraints=UNIQUE, partition_by=["p"]))
    # Outside the predicates a row isn't matched, and would be doubled.
    limited = Load(unique_key="id", constraints=UNIQUE, partition_by=["p"], predicates="target.p = 1")
    refused(spark, frame(spark, (1, "A", 0)), name, limited)
    moved = Load(strategy="delete+insert", unique_key="v", constraints=UNIQUE, partition_by=["p"])
    load(frame(spark, (70, "a", 0)), name, moved)  # the row with id 1 goes
    load(frame(spark, (1, "new", 0)), name, moved)
    assert spark.table(name).filter("id in (1, 70)").count() == 2


def test_overwrites_look_at_what_stays(spark, name):
    cfg = Load(strategy="insert_overwrite", partition_by=["p"], constraints=UNIQUE)
    load(frame(spark, *OLD[:4]), name, cfg)
    load(frame(spark, (1, "A", 0), (5, "e", 0)), name, cfg)  # partition 0 is replaced
    refused(spark, frame(spark, (3, "C", 0)), name, cfg)  # 3 stays in partition 1
    static = Load(strategy="insert_overwrite", partition_by=["p"], overwrite_values=[0, 1], constraints=UNIQUE)
    load(frame(spark, (3, "C", 0)), name, static)
    assert rows(spark.table(name)) == [(3, "C", 0)]
    whole = Load(strategy="insert_overwrite", constraints=UNIQUE)
    load(frame(spark, (3, "x", 0)), f"{name}_u", whole)
    load(frame(spark, (3, "y", 0)), f"{name}_u", whole)
    assert rows(spark.table(f"{name}_u"), "v") == [("y",)]


def test_composite_keys_types_and_parts(spark, name):
    cfg = Load(strategy="append", partition_by=["p"], constraints=[Constraint("primary_key", ("id", "v"), name="pk")])
    load(frame(spark, *OLD[:4], schema="id long, v string, p int"), name, cfg)
    load(frame(spark, (1, "b", 0), (2, "a", 1)), name, cfg)
    with pytest.raises(SchemaMismatch, match="pk"):  # an int against the table's long
        load(frame(spark, (9, "z", 3), (4, "d", 9)), name, cfg)
    with pytest.raises(SchemaMismatch, match="pk"):
        load_in_parts(frame(spark, (9, "z", 3), (4, "d", 9)), name, cfg, 1)
    assert spark.table(name).count() == 6


def test_windows_look_at_the_others(spark, name):
    import datetime as dt

    day = dt.datetime
    events = spark.createDataFrame([(i, day(2024, 1, 1 + i)) for i in range(4)], "id int, at timestamp_ntz")
    events = events.withColumn("day", F.col("at").cast("date"))
    cfg = Load(event_time="at", batch_size="day", partition_by=["day"], constraints=UNIQUE)
    load(events, name, Load(partition_by=["day"]))
    load_microbatches(events, name, cfg, day(2024, 1, 2), day(2024, 1, 3))  # the window's own rows are replaced
    clash = events.filter("id = 1").withColumn("id", F.lit(3))
    with pytest.raises(SchemaMismatch, match="unique_id"):
        load_microbatches(clash, name, cfg, day(2024, 1, 2), day(2024, 1, 3))
    assert rows(spark.table(name), "id") == [(0,), (1,), (2,), (3,)]


def test_the_filter_lets_no_key_through_and_few_others(spark):
    some = spark.range(0, 100_000, 1000).selectExpr("cast(id as string) as k", "id % 3 as j")
    many = spark.range(100_000).selectExpr("cast(id as string) as k", "id % 3 as j", "id as _at", "id as _word")
    got = probably_among(many, some, ["k", "j"])
    assert got.columns == many.columns
    found = {r.k for r in got.collect()}
    assert {str(i) for i in range(0, 100_000, 1000)} <= found and len(found) < 2_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

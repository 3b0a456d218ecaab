import datetime as dt

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import history as hist
from tidemark.session import stage
from tidemark.plans.snapshot import read_history, take_snapshot

T = dt.datetime
NOW0, NOW1, NOW2, NOW3 = T(2024, 1, 1), T(2024, 1, 2), T(2024, 1, 3), T(2024, 1, 4)
PEOPLE = "id int, name string, email string, updated_at timestamp_ntz"


def person(i, name=None, email=None, day=1, hour=0):
    return (i, name or f"p{i}", email or f"{i}@x", T(2015, 12, day, hour))


@pytest.fixture
def people(spark):
    return spark.createDataFrame([person(i) for i in range(1, 21)], PEOPLE)


def applied(*args):
    """The outcome written down, so that repeated looks at it cost nothing."""
    return stage(hist.apply(*args)).frame


def cfg(**settings):
    return hist.Snapshot(settings.pop("key", "id"), settings.pop("strategy", hist.timestamp_strategy("updated_at")), **settings)


def test_first_build(people):
    built = hist.first_build(people, cfg(), NOW0)
    assert built.count() == 20 and built.filter("valid_to IS NULL AND valid_from = updated_at").count() == 20
    row = built.filter("id = 1").first()
    import hashlib

    assert row.scd_id == hashlib.md5(b"1|2015-12-01 00:00:00.000000").hexdigest()


def test_timestamp_update_closes_and_opens(people):
    later = people.withColumn("updated_at", F.when(F.col("id") >= 10, F.expr("updated_at + interval 1 hour")).otherwise(F.col("updated_at")))
    history = applied(hist.first_build(people, cfg(), NOW0), later, cfg(), NOW1)
    assert history.count() == 31
    assert rows(history.filter("id = 10"), "valid_from", "valid_to") == [
        (T(2015, 12, 1), T(2015, 12, 1, 1)), (T(2015, 12, 1, 1), None),
    ]
    again = applied(history, later, cfg(), NOW2)
    assert rows(again) == rows(history)
    # An older row is no change.
    assert rows(applied(history, people, cfg(), NOW2)) == rows(history)
    assert hist.as_of(history, cfg(), T(2015, 12, 1, 0, 30)).count() == 20


def test_check_strategy(spark):
    schema = "id int, name string, seen date"
    old = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "c", None), (4, "d", None)], schema)
    new = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", None), (3, None, None), (5, "e", None)], schema)

    def changed(columns):
        settings = cfg(strategy=hist.check_strategy(columns))
        got = applied(hist.first_build(old, settings, NOW0), new, settings, NOW1)
        return rows(got.filter(F.col("valid_from") == F.lit(str(NOW1)).cast("timestamp_ntz")), "id")

    assert changed(["name"]) == [(2,), (3,), (5,)]
    assert changed("all") == [(1,), (2,), (3,), (5,)]
    assert changed(["seen"]) == [(1,), (5,)]
    for wrong in ([], "name", ""):
        with pytest.raises(ValueError):
            hist.check_strategy(wrong)


def test_new_checked_column_reversions_every_row(people):
    settings = cfg(strategy=hist.check_strategy(["name", "email"]))
    history = hist.first_build(people.drop("email"), settings, NOW0)
    got = applied(history, people, settings, NOW1)
    assert got.count() == 40 and got.filter("valid_to IS NULL AND email IS NOT NULL").count() == 20
    assert got.filter("valid_to IS NOT NULL AND email IS NULL").count() == 20


def test_deletions(people):
    source = people.filter("id > 1")
    for mode, expected in (("ignore", [(None,)]), ("invalidate", [(NOW1,)])):
        settings = cfg(hard_deletes=mode)
        got = applied(hist.first_build(people, settings, NOW0), source, settings, NOW1)
        assert rows(got.filter("id = 1"), "valid_to") == expected


@pytest.mark.parametrize("current_value", [None, T(9999, 12, 31)])
def test_deletion_as_record_and_return(people, spark, current_value):
    settings = cfg(hard_deletes="new_record", current_value=current_value)
    one = "id = 1"
    first = hist.first_build(people, settings, NOW0)
    gone = applied(first, people.filter("id > 1"), settings, NOW1)
    shown = ["is_deleted", "valid_from", "valid_to"]
    deleted = [("False", T(2015, 12, 1), NOW1), ("True", NOW1, current_value)]
    assert rows(gone.filter(one), *shown) == deleted and gone.count() == 21
    # Still gone: nothing more happens.
    assert rows(applied(gone, people.filter("id > 1"), settings, NOW2)) == rows(gone)
    back = people.filter("id > 1").unionByName(spark.createDataFrame([(1, "p1", "1@x", T(2024, 1, 3, 5))], PEOPLE))
    returned = applied(gone, back, settings, NOW3)
    assert rows(returned.filter(one), *shown) == [
        ("False", T(2015, 12, 1), NOW1), ("False", T(2024, 1, 3, 5), current_value), ("True", NOW1, T(2024, 1, 3, 5)),
    ]


def test_current_sentinel_and_null_both_count_as_open(people):
    far = T(9999, 12, 31)
    plain = hist.first_build(people, cfg(), NOW0)
    settings = cfg(current_value=far)
    moved = people.withColumn("updated_at", F.expr("updated_at + interval 1 day"))
    got = applied(plain, moved, settings, NOW1)
    assert got.count() == 40
    assert got.filter("valid_to = timestamp_ntz'9999-12-31'").count() == 20 and got.filter("valid_to IS NULL").count() == 0


def test_composite_key_with_null_part(spark):
    schema = "a int, b string, v int, updated_at timestamp_ntz"
    old = spark.createDataFrame([(1, "x", 1, NOW0), (1, "y", 1, NOW0), (2, None, 1, NOW0)], schema)
    settings = cfg(key=["a", "b"])
    new = spark.createDataFrame([(1, "x", 2, NOW1), (1, "y", 1, NOW0), (2, None, 1, NOW0)], schema)
    got = applied(hist.first_build(old, settings, NOW0), new, settings, NOW2)
    # The null key matches nothing, but its surrogate is known: no second version.
    assert rows(got, "a", "b", "v", "valid_to") == [(1, "x", 1, NOW1), (1, "x", 2, None), (1, "y", 1, None), (2, None, 1, None)]
    settings = cfg(key=["a", "b"], hard_deletes="invalidate")
    got = applied(hist.first_build(old, settings, NOW0), new, settings, NOW2)
    assert rows(got.filter("b IS NULL"), "valid_to") == [(NOW2,)]


def test_null_safe_composite_key(spark):
    schema = "a int, b string, v int, updated_at timestamp_ntz"
    old = spark.createDataFrame([(2, None, 1, NOW0), (3, "x", 1, NOW0)], schema)
    new = spark.createDataFrame([(2, None, 5, NOW1), (3, "x", 1, NOW0)], schema)
    settings = cfg(key=["a", "b"], null_safe_key=True)
    got = applied(hist.first_build(old, settings, NOW0), new, settings, NOW2)
    assert rows(got, "a", "v", "valid_to") == [(2, 1, NOW1), (2, 5, None), (3, 1, None)]


def test_columns_added_and_removed(people):
    history = hist.first_build(people, cfg(), NOW0)
    new = people.drop("email").withColumn("note", F.lit("n")).withColumn("updated_at", F.expr("updated_at + interval 1 day"))
    got = applied(history, new, cfg(), NOW1)
    assert got.columns == [*history.columns, "note"]
    assert got.filter("valid_to IS NULL AND note = 'n' AND email IS NULL").count() == 20
    assert got.filter("valid_to IS NOT NULL AND note IS NULL AND email IS NOT NULL").count() == 20


def test_repeated_source_key_raises(people):
    history = hist.first_build(people, cfg(), NOW0)
    with pytest.raises(PySparkException, match="repeats"):
        applied(history, people.unionByName(people.filter("id = 3")), cfg(), NOW1).count()


def test_settings_are_checked(people):
    with pytest.raises(ValueError):
        cfg(hard_deletes="drop")
    with pytest.raises(ValueError):
        cfg(key=[])
    with pytest.raises(ValueError):
        hist.hard_deletes_from("ignore", True)
    assert [hist.hard_deletes_from(), hist.hard_deletes_from(invalidate_hard_deletes=True)] == ["ignore", "invalidate"]
    with pytest.raises(ValueError, match="meta columns"):
        hist.apply(people, people, cfg(), NOW0)
    with pytest.raises(ValueError, match="is_deleted"):
        applied(hist.first_build(people, cfg(), NOW0), people, cfg(hard_deletes="new_record"), NOW0)
    with pytest.raises(ValueError, match="clash"):
        hist.first_build(people.withColumn("valid_from", F.lit(1)), cfg(), NOW0)


def test_renamed_meta_columns_and_custom_strategy(people):
    settings = hist.with_meta(cfg(), valid_from="start", valid_to="stop", scd_id="sid", updated_at="upd")
    built = hist.first_build(people, settings, NOW0)
    assert built.columns[-4:] == ["sid", "upd", "start", "stop"]
    custom = hist.Strategy("updated_at", lambda source, history, c: F.length("src.name") > F.length("cur.name"))
    grown = people.withColumn("name", F.when(F.col("id") < 3, "longer").otherwise(F.col("name"))).withColumn(
        "updated_at", F.expr("updated_at + interval 1 day"))
    got = applied(hist.first_build(people, cfg(), NOW0), grown, cfg(strategy=custom), NOW1)
    assert got.count() == 22


def test_plan_has_no_cross_join_and_no_single_partition_window(people):
    settings = cfg(hard_deletes="new_record")
    got = hist.apply(hist.first_build(people, settings, NOW0), people, settings, NOW1)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Window" not in plan


def test_snapshot_table(spark, people, name):
    settings = cfg(hard_deletes="invalidate")
    take_snapshot(people, name, settings, NOW0)
    later = people.filter("id <> 5").withColumn(
        "updated_at", F.when(F.col("id") == 7, F.expr("updated_at + interval 1 day")).otherwise(F.col("updated_at")))
    take_snapshot(later, name, settings, NOW1)
    expected = applied(hist.first_build(people, settings, NOW0), later, settings, NOW1)
    assert rows(read_history(spark, name).select(expected.columns)) == rows(expected)
    take_snapshot(later, name, settings, NOW2)
    assert rows(read_history(spark, name).select(expected.columns)) == rows(expected)
    closed = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect() if "open" not in r[0]]
    before = spark.table(name).filter("closed_in <> 'open'").inputFiles()
    take_snapshot(later.withColumn("note", F.lit("x")), name, settings, NOW3)
    assert spark.table(name).filter("closed_in <> 'open'").inputFiles() == before and len(closed) == 1
    assert "note" in spark.table(name).columns
    spark.range(1).createOrReplaceTempView(f"{name}_v")
    with pytest.raises(ValueError):
        take_snapshot(people, f"{name}_v", settings, NOW0)

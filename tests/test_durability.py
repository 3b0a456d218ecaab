"""Loads, snapshots and streams that once lost, doubled or endangered rows."""

import datetime as dt
import os
import threading

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import freshness, incremental as inc
from tidemark.operators import history as hist
from tidemark.operators import quality
from tidemark.operators.history import Snapshot, check_strategy, timestamp_strategy
from tidemark.operators.merge import merge
from tidemark.operators.schema import Constraint, SchemaMismatch
from tidemark.plans import load as loading
from tidemark.plans.load import Load, load, load_in_parts, load_microbatches, load_seed
from tidemark.plans.materialized import FollowingTable
from tidemark.plans.publish import replace_table, shape, table_location
from tidemark.plans.snapshot import read_history, take_snapshot
from tidemark.session import scratch_root
from tidemark.streaming import streams

T = dt.datetime


def hours(spark, first, count, step=1):
    return spark.createDataFrame(
        [(i, first + dt.timedelta(hours=i * step)) for i in range(count)], "id int, at timestamp_ntz"
    ).withColumn("day", F.col("at").cast("date"))


BY_DAY = Load(event_time="at", batch_size="day", partition_by=["day"])


# -- full refresh, parts and windows ----------------------------------------------------------------------------


def test_full_refresh_belongs_to_the_first_window(spark, name):
    source = hours(spark, T(2024, 1, 1), 10, 24)
    load(source.withColumn("id", F.lit(-1)), name, Load(partition_by=["day"]))
    cfg = Load(**{**BY_DAY.__dict__, "full_refresh": True})
    assert load_microbatches(source, name, cfg, T(2024, 1, 1), T(2024, 1, 11)) == 10
    assert rows(spark.table(name), "id") == [(i,) for i in range(10)]


def test_full_refresh_belongs_to_the_first_part(spark, name):
    df = spark.range(10).withColumn("p", F.col("id") % 5)
    load(df.withColumn("id", F.lit(99).cast("bigint")), name, Load(strategy="append", partition_by=["p"]))
    load_in_parts(df, name, Load(strategy="append", partition_by=["p"], full_refresh=True), 1)
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(10))


def test_listed_partitions_are_cleared_once(spark, name):
    df = spark.range(10).withColumn("p", F.col("id") % 5)
    load(df, name, Load(strategy="append", partition_by=["p"]))
    cfg = Load(strategy="insert_overwrite", partition_by=["p"], overwrite_values=list(range(5)))
    load_in_parts(df.withColumn("id", F.col("id") + 100).filter("p <> 4"), name, cfg, 1)
    assert sorted(r.id for r in spark.table(name).collect()) == [100, 101, 102, 103, 105, 106, 107, 108]


def test_keys_in_several_parts_are_refused(spark, name):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "id int, p int")
    for strategy in ("merge", "delete+insert"):
        with pytest.raises(ValueError):
            load_in_parts(df, name, Load(strategy=strategy, unique_key="id", partition_by=["p"]), 1)


def test_windows_must_fit_the_partitions(spark, name):
    source = hours(spark, T(2024, 1, 1), 10, 24).withColumn("month", F.trunc("at", "month")).drop("day")
    cfg = Load(event_time="at", batch_size="day", partition_by=["month"], microbatch_style="overwrite")
    load(source, name, Load(partition_by=["month"]))
    with pytest.raises(ValueError):
        load_microbatches(source, name, cfg, T(2024, 1, 1), T(2024, 1, 11))
    assert spark.table(name).count() == 10
    with pytest.raises(ValueError):  # said before any job
        loading.validate(Load(**{**cfg.__dict__, "strategy": "microbatch", "partition_grain": "month"}))


def test_the_last_window_is_whole(spark, name):
    source = hours(spark, T(2024, 1, 1), 48)
    load(source, name, Load(partition_by=["day"]))
    for end in (T(2024, 1, 2, 6), T(2024, 1, 2, 13, 57)):
        load_microbatches(source, name, BY_DAY, T(2024, 1, 2, 3), end)
        assert spark.table(name).count() == 48


def test_rows_gone_from_a_window_are_gone_from_its_partition(spark, name):
    source = hours(spark, T(2024, 1, 1), 72)
    load(source, name, Load(partition_by=["day"]))
    load_microbatches(source.filter("day(at) <> 2"), name, BY_DAY, T(2024, 1, 1), T(2024, 1, 4))
    assert spark.table(name).count() == 48


def test_partitioning_must_be_that_of_the_table(spark, name):
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, year int")
    load(df, name, Load())
    for cfg in (Load(partition_by=["year"]), Load(strategy="append", partition_by=["year"])):
        with pytest.raises(ValueError):
            load(df.filter("year = 2024"), name, cfg)
        with pytest.raises(ValueError):
            load_in_parts(df.filter("year = 2024"), name, cfg, 1)
    assert spark.table(name).count() == 2


# -- overwrites and the session ---------------------------------------------------------------------------------


def test_overlapping_loads_keep_every_row_and_the_sessions_setting(spark, name):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    cfg = Load(strategy="insert_overwrite", partition_by=["p"])
    load(spark.range(8).withColumn("p", F.col("id").cast("int")), name, cfg)

    def run(p):
        load(spark.range(3).select(F.col("id") + 10 * p, F.lit(p).alias("p")).toDF("id", "p"), name, cfg)

    threads = [threading.Thread(target=run, args=(p,)) for p in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    spark.catalog.refreshTable(name)
    want = sorted([10 * p + i for p in range(6) for i in range(3)] + [6, 7])
    assert sorted(r.id for r in spark.table(name).collect()) == want
    assert spark.conf.get(setting) == before


def test_a_partitioned_merge_runs_its_plan_once(spark, name, monkeypatch):
    target = spark.range(100).withColumn("v", F.lit(0)).withColumn("p", F.col("id") % 4)
    load(target, name, Load(strategy="append", partition_by=["p"]))
    calls = []
    real = loading.write_partitions
    monkeypatch.setattr(loading, "write_partitions", lambda df, *a, **k: calls.append(df) or real(df, *a, **k))
    tracker = spark.sparkContext.statusTracker()
    group = f"merge-{name}"
    spark.sparkContext.setJobGroup(group, "one merge")
    batch = target.filter("id < 30 and p = 1").withColumn("v", F.lit(1)).withColumn("p", F.lit(2).cast("bigint"))
    load(batch, name, Load(unique_key="id", partition_by=["p"]))
    spark.sparkContext.setJobGroup("other", "")
    assert len(calls) == 1  # and nothing else computes the merged rows
    plan = calls[0]._jdf.queryExecution().optimizedPlan().toString()
    scans = plan.count("Relation")
    assert scans <= 12 and tracker.getJobIdsForGroup(group)
    assert spark.table(name).filter("v = 1 and p = 2").count() == 8 and spark.table(name).count() == 100


# -- snapshots --------------------------------------------------------------------------------------------------


def test_two_runs_with_one_clock_keep_what_both_closed(spark, name):
    def people(*found):
        return spark.createDataFrame(list(found), "id int, v string")

    cfg = Snapshot("id", check_strategy("all"))
    take_snapshot(people((1, "a"), (2, "x")), name, cfg, T(2024, 1, 1))
    take_snapshot(people((1, "b"), (2, "x")), name, cfg, T(2024, 1, 2))
    take_snapshot(people((1, "b"), (2, "y")), name, cfg, T(2024, 1, 2))
    got = rows(read_history(spark, name), "id", "v", "valid_to")
    assert got == [(1, "a", T(2024, 1, 2)), (1, "b", None), (2, "x", T(2024, 1, 2)), (2, "y", None)]


def test_lookup_of_known_versions_is_pushed_down(spark, name, monkeypatch):
    source = spark.createDataFrame([(1, T(2024, 1, 5)), (2, T(2024, 1, 6))], "id int, at timestamp_ntz")
    cfg = Snapshot("id", timestamp_strategy("at"), hard_deletes="invalidate")
    take_snapshot(source, name, cfg, T(2024, 2, 1))
    take_snapshot(source.filter("id = 1"), name, cfg, T(2024, 2, 2))
    seen = []
    real = hist._marked
    monkeypatch.setattr(hist, "_marked", lambda v, o, c, n: seen.append(o) or real(v, o, c, n))
    take_snapshot(source, name, cfg, T(2024, 2, 3))  # 2 is back with the time it had: its version is known
    assert rows(read_history(spark, name), "id", "valid_to") == [(1, None), (2, T(2024, 2, 2))]
    at = F.col("scd_updated_at")
    plan = seen[0].filter((at >= F.lit(T(2024, 1, 5))) & (at <= F.lit(T(2024, 1, 6))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(scd_updated_at" in text


# -- time zones -------------------------------------------------------------------------------------------------

ZONES = ["America/New_York", "UTC", "Europe/Berlin"]


def in_zone(spark, zone, work):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        return work()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_surrogates_ages_and_windows_do_not_depend_on_the_zone(spark, tmp_path):
    path, files = str(tmp_path / "t"), str(tmp_path / "f")
    moments = [T(2024, 3, 10, 2, 30), T(2024, 3, 31, 2, 30), T(2024, 7, 1, 0, 0, 0, 123)]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "id int, wall timestamp_ntz")
    df.withColumn("instant", F.timestamp_micros(F.lit(1_710_000_000_123_456) + F.col("id"))).write.parquet(path)
    spark.range(1).write.parquet(files)

    def work():
        read = spark.read.parquet(path)
        got = []
        for column in ("wall", "instant"):
            cfg = Snapshot("id", timestamp_strategy(column))
            first = hist.first_build(read, cfg, T(2024, 1, 1))
            got.append([r.scd_id for r in first.orderBy("id").collect()])
            got.append(hist.apply(first, read, cfg, T(2024, 1, 2)).count())
        ids = hist.first_build(read, Snapshot("wall", check_strategy("all")), T(2024, 1, 1))
        got.append(sorted(r.scd_id for r in ids.collect()))
        age = freshness.by_files(spark, files, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).first()["age"]
        assert 0 <= age < 600
        got.append(freshness.by_field(read, "instant", T(2024, 3, 9, 17)).first()["age"])
        stream = spark.readStream.schema(read.schema).parquet(path)
        windows = streams.tumbling(stream, "wall", "1 hour", "1 minute", ["id"], {"n": F.count(F.lit(1))})
        sink = str(tmp_path / spark.conf.get("spark.sql.session.timeZone").replace("/", "_"))
        streams.append_stream(windows, sink, sink + "_cp").awaitTermination()
        got.append(rows(spark.read.schema(windows.schema).parquet(sink), "window_start"))
        return got

    results = [in_zone(spark, zone, work) for zone in ZONES]
    assert results[0] == results[1] == results[2]
    assert results[0][-1] == [(T(2024, 3, 10, 2),), (T(2024, 3, 31, 2),)]


# -- streams and following tables -------------------------------------------------------------------------------


def deliver(spark, path, found, schema):
    spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(path)


def test_an_older_row_in_a_later_delivery_changes_nothing(spark, tmp_path, name):
    path, schema = str(tmp_path / "in"), "k int, at int, v string, b int"
    cfg = Load(unique_key="k", partition_by=["b"])

    def run():
        streams.upsert_stream(streams.file_stream(spark, path, 1), name, cfg, ["at"], str(tmp_path / "cp")).awaitTermination()
        return rows(spark.table(name), "k", "at", "v")

    deliver(spark, path, [(1, 5, "new", 0), (2, 1, "x", 0)], schema)
    assert run() == [(1, 5, "new"), (2, 1, "x")]
    deliver(spark, path, [(1, 3, "late", 0), (2, 2, "y", 0)], schema)
    assert run() == [(1, 5, "new"), (2, 2, "y")]


def test_a_repeated_micro_batch_counts_once(spark, tmp_path, name):
    path, schema = str(tmp_path / "in"), "k int, at int, n int, b int"
    cfg = Load(unique_key="k", partition_by=["b"], rules={"n": "sum"})
    handled = []
    real = streams._start

    def start(stream, table, handle, checkpoint, every):
        handled.append(handle)
        return real(stream, table, handle, checkpoint, every)

    streams._start, before = start, streams._start
    try:
        deliver(spark, path, [(1, 1, 5, 0)], schema)
        streams.upsert_stream(streams.file_stream(spark, path, 1), name, cfg, ["at"], str(tmp_path / "cp")).awaitTermination()
    finally:
        streams._start = before
    handled[0](spark.createDataFrame([(1, 1, 5, 0)], schema), 0)  # the same micro-batch again
    assert rows(spark.table(name), "n") == [(5,)]
    handled[0](spark.createDataFrame([(1, 2, 3, 0)], schema), 1)
    assert rows(spark.table(name), "n") == [(8,)]


def test_full_refresh_belongs_to_the_first_micro_batch(spark, tmp_path, name):
    path, schema = str(tmp_path / "in"), "k int, at int, b int"
    load(spark.createDataFrame([(9, 9, 0)], schema), name, Load(partition_by=["b"]))
    cfg = Load(unique_key="k", partition_by=["b"], full_refresh=True)
    for k in (1, 2, 3):
        deliver(spark, path, [(k, 1, 0)], schema)
    streams.upsert_stream(streams.file_stream(spark, path, 1), name, cfg, ["at"], str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.table(name), "k") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("files", [1, None])
def test_history_does_not_depend_on_the_cuts(spark, tmp_path, name, files):
    path, schema = str(tmp_path / "in"), "k int, at timestamp_ntz, v string"
    changes = [(1, T(2024, 1, d), v) for d, v in ((1, "a"), (2, "b"), (3, "b"), (4, "c"))] + [(2, T(2024, 1, 2), "x"), (None, T(2024, 1, 1), "n")]
    for part in (changes[:3], changes[3:]):
        deliver(spark, path, part, schema)
    cfg = Snapshot("k", check_strategy(["v"], updated_at="at"))
    for _ in range(2):  # the second run has nothing to do
        streams.history_stream(
            streams.file_stream(spark, path, files), name, cfg, [F.desc("at")], str(tmp_path / "cp")
        ).awaitTermination()
    got = rows(read_history(spark, name), "k", "v", "valid_from", "valid_to")
    assert [r for r in got if r[0] == 1] == [
        (1, "a", T(2024, 1, 1), T(2024, 1, 2)), (1, "b", T(2024, 1, 2), T(2024, 1, 4)), (1, "c", T(2024, 1, 4), None),
    ]
    assert len(got) == 5


def test_a_following_table_holds_what_its_query_gives(spark, name):
    view, lag = f"{name}_src", dt.timedelta(hours=1)

    def source(*found):
        spark.createDataFrame(list(found), "id int, at int").createOrReplaceTempView(view)

    source((1, 1), (2, 5))
    table = FollowingTable(name, lambda s: s.table(view), lag, watermark="at", loading=Load(unique_key="id"))
    assert table.refresh_if_due(spark, T(2024, 1, 1)) == "create"
    source((2, 5), (3, 5), (4, 2), (5, 9))  # a tie, a late row, a new one; 1 is gone
    assert table.refresh_if_due(spark, T(2024, 1, 2)) == "full"
    assert rows(spark.table(name), "id") == [(2,), (3,), (4,), (5,)]
    near = FollowingTable(
        name, lambda s: s.table(view), lag, refresh_mode="incremental", watermark="at", lookback=4, loading=Load(unique_key="id")
    )
    source((2, 6), (3, 5), (6, 5), (7, 1), (5, 9))
    assert near.refresh_if_due(spark, T(2024, 1, 3)) == "incremental"
    assert rows(spark.table(name), "id", "at") == [(2, 6), (3, 5), (4, 2), (5, 9), (6, 5)]


def test_immutable_rows_stay(spark, name):
    view, lag = f"{name}_src", dt.timedelta(hours=1)
    spark.createDataFrame([(1, "a"), (10, "b")], "id int, v string").createOrReplaceTempView(view)
    table = FollowingTable(name, lambda s: s.table(view), lag, immutable_where="id < 5")
    table.refresh_if_due(spark, T(2024, 1, 1))
    spark.createDataFrame([(1, "z"), (2, "z"), (11, "c")], "id int, v string").createOrReplaceTempView(view)
    assert table.refresh_if_due(spark, T(2024, 1, 2)) == "full"
    assert rows(spark.table(name)) == [(1, "a"), (11, "c")]


# -- what tables keep -------------------------------------------------------------------------------------------


def test_rewrites_keep_format_place_properties_and_comments(spark, name, tmp_path):
    place = str(tmp_path / "place")
    source = hours(spark, T(2024, 1, 1), 48).drop("day")
    cfg = Load(event_time="at", batch_size="day", microbatch_style="delete+insert")
    load(source, name, Load(file_format="orc", location=place))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner.team' = 'tides')")
    spark.sql(f"COMMENT ON TABLE {name} IS 'all hours'")
    spark.sql(f"ALTER TABLE {name} ALTER COLUMN id COMMENT 'a number'")
    old = table_location(spark, name)
    load_microbatches(source, name, cfg, T(2024, 1, 1), T(2024, 1, 3))
    load(source.withColumn("extra", F.lit(1)), name, Load(unique_key="id", on_schema_change="sync_all_columns"))
    kept = shape(spark, name)
    assert kept.provider == "orc" and kept.location.startswith(f"file:{place}/")
    assert kept.properties == {"owner.team": "tides"} and kept.comment == "all hours"
    assert kept.column_comments == {"id": "a number"}
    assert not os.path.exists(old.removeprefix("file:")) and spark.table(name).count() == 48


def test_rewrites_keep_buckets(spark, name):
    replace_table(spark.range(10), name, bucket_by=["id"], buckets=4)
    load(spark.range(5, 15), name, Load(unique_key="id"))
    kept = shape(spark, name)
    assert (kept.bucket_by, kept.buckets) == (["id"], 4) and spark.table(name).count() == 15


def test_publishing_never_removes_a_neighbours_folder(spark, name, tmp_path):
    place = str(tmp_path / "x")
    replace_table(spark.range(1), f"{name}_a", location=f"{place}/{name}")
    replace_table(spark.range(2), f"{name}_b", location=f"{place}/{name}/deep")
    replace_table(spark.range(3), f"{name}_b", location=f"{place}/other")
    assert spark.table(f"{name}_a").count() == 1 and spark.table(f"{name}_b").count() == 3


def test_loads_leave_nothing_staged(spark, name):
    before = set(os.listdir(scratch_root(spark))) if os.path.isdir(scratch_root(spark)) else set()
    cfg = Load(unique_key="id", partition_by=["p"])
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    load(df, name, cfg)
    load(df, name, cfg)
    with pytest.raises(Exception):  # repeated keys: the failed load cleans up as well
        load(df.union(df), name, cfg)
    assert set(os.listdir(scratch_root(spark))) - before == set()
    assert spark.table(name).count() == 10


def test_seeding_again_keeps_the_types(spark, name, tmp_path):
    path = str(tmp_path / "seed.csv")
    for text, want in (("id,v\n1,a\n2,b\n", [(1, "a"), (2, "b")]), ("id,v\n3,c\n", [(3, "c")])):
        with open(path, "w") as f:
            f.write(text)
        load_seed(spark, path, name, column_types={"id": "bigint"})
        assert rows(spark.table(name)) == want and spark.table(name).schema["id"].dataType.simpleString() == "bigint"


# -- merges -----------------------------------------------------------------------------------------------------


def test_predicates_over_batch_columns_with_a_map_column(spark):
    schema = "id int, v int, m map<string,int>"
    old = spark.createDataFrame([(1, 1, {"a": 1}), (2, 2, {"b": 2})], schema)
    new = spark.createDataFrame([(1, 5, {"a": 9}), (2, 0, {"c": 3})], schema)
    got = merge(old, new, "id", predicates="batch.v > target.v")
    assert sorted((r.id, r.v, tuple(r.m.items())) for r in got.collect()) == [
        (1, 5, (("a", 9),)), (2, 0, (("c", 3),)), (2, 2, (("b", 2),)),
    ]
    with pytest.raises(Exception, match="several batch rows"):
        merge(old, new.union(new), "id", predicates="batch.v > target.v").collect()


def test_rules_replace_whole_names_only(spark):
    old = spark.createDataFrame([(1, "o", True)], "id int, v string, is_new_flag boolean")
    new = spark.createDataFrame([(1, "n", False)], "id int, v string, is_new_flag boolean")
    rule = "concat(_old_, '_new_', _new_, if(target.is_new_flag, '!', ''))"
    assert rows(merge(old, new, "id", rules={"v": rule}), "v") == [("o_new_n!",)]


def test_misspelt_predicates_are_errors(spark):
    df = spark.range(2)
    with pytest.raises(Exception):
        merge(df, df, "id", predicates="target.nope > 1").collect()


# -- contracts, stored failures, fixtures -----------------------------------------------------------------------


def test_contracts_and_constraints_guard_a_load(spark, name):
    good = spark.createDataFrame([(1, "a")], "id int, v string")
    cfg = Load(unique_key="id", contract=good.schema, constraints=[Constraint("check", condition="id > 0")])
    load(good, name, cfg)
    for bad in (spark.createDataFrame([(1, "a", 1)], "id int, v string, w int"), good.withColumn("id", F.lit(-1))):
        with pytest.raises(SchemaMismatch):
            load(bad, name, cfg)
    assert rows(spark.table(name)) == [(1, "a")]


def test_the_limit_applies_to_what_is_stored(spark, name):
    verdict = quality.evaluate_stored(spark.range(100), name, limit=7).first()
    assert verdict["failures"] == 7 and spark.table(name).count() == 7


def test_a_fixture_is_one_frame(spark):
    schema = spark.createDataFrame([], "id int, v decimal(10,2), at timestamp_ntz").schema
    df = quality.fixture(spark, [{"ID": i, "v": "1.5" if i % 2 else 2} for i in range(200)], schema)
    assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.schema == schema or df.count() == 200


def test_suite_with_relationships_reads_unique_columns_once(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (3, 2, None)], "x int, y int, z string")
    parent = spark.createDataFrame([(1,)], "x int")
    checks = [
        quality.Check("unique", "x"), quality.Check("unique", "y"), quality.Check("unique", "z"),
        quality.Check("relationships", "x", parent=parent), quality.Check("not_null", "z"),
    ]
    assert rows(quality.suite(df, checks)) == [
        ("not_null_z", 1), ("relationships_x", 1), ("unique_x", 1), ("unique_y", 1), ("unique_z", 0),
    ]


def test_microbatch_functions_take_whole_windows(spark):
    target = hours(spark, T(2024, 1, 1), 48).drop("day")
    got = inc.microbatch_overwrite(target, target, "at", "day", T(2024, 1, 2, 3), T(2024, 1, 2, 6))
    assert got.count() == 48

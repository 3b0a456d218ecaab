import datetime as dt

import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import partitions
from tidemark.operators.history import Snapshot, check_strategy, timestamp_strategy
from tidemark.plans import publish
from tidemark.plans.load import Load
from tidemark.plans.materialized import FollowingTable, MaterializedTable
from tidemark.plans.model import Context, run_model
from tidemark.plans.snapshot import read_history
from tidemark.session import scratch_path, scratch_root, stage
from tidemark.sources import files, scan, sinks
from tidemark.streaming import streams

T = dt.datetime


def _csv(tmp_path, text, name="seed.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_seed_types(spark, tmp_path):
    path = _csv(
        tmp_path,
        "﻿id,price,ok,day,at,clock,name,empty,mixed\n"
        "1,1.5,true,2020-01-01,2020-01-01 10:00:00,10:30:00,x,,1\n"
        "-2,3,FALSE,2020-02-29,2020-01-02T11:12:13.5,11:00:00,'a b',,z\n"
        "3,,,,,,,,\n",
    )
    seed = files.read_seed(spark, path)
    assert [f.dataType.simpleString() for f in seed.schema] == [
        "bigint", "double", "boolean", "date", "timestamp_ntz", "string", "string", "string", "string",
    ]
    assert seed.columns[0] == "id"
    assert rows(seed, "id", "price", "ok", "day")[0] == (-2, 3.0, False, dt.date(2020, 2, 29))
    typed = files.read_seed(spark, path, column_types={"ID": "string", "price": "decimal(5,2)"})
    assert typed.dtypes[:2] == [("id", "string"), ("price", "decimal(5,2)")]
    with pytest.raises(ValueError):
        files.read_seed(spark, path, column_types={"nope": "int"})
    assert {t for _, t in files.read_seed(spark, path, infer=False).dtypes} == {"string"}


def test_seed_quoting_delimiter_and_emptiness(spark, tmp_path):
    path = _csv(tmp_path, 'id|word\n1|"a|b"\n2|"say ""hi"""\n3|żółć\n')
    assert rows(files.read_seed(spark, path, delimiter="|")) == [(1, "a|b"), (2, 'say "hi"'), (3, "żółć")]
    assert files.read_seed(spark, _csv(tmp_path, "a,b\n", "empty.csv")).count() == 0
    lines = _csv(tmp_path, 'id,t\n1,"two\nlines"\n', "lines.csv")
    assert rows(files.read_seed(spark, lines, multi_line=True)) == [(1, "two\nlines")]


def test_bulk_load(spark, tmp_path):
    path = _csv(tmp_path, '{"a": 1}\n{"a": 2, "b": "x"}\n', "f.json")
    assert rows(files.load_files(spark, path, "json", "a int, b string")) == [(1, None), (2, "x")]


def test_scan(spark):
    df = spark.createDataFrame([(i, T(2025, 1, i, 1)) for i in (1, 2, 3)], "id int, at timestamp_ntz")
    assert scan.scan(df, limit=0).schema == df.schema and scan.scan(df, limit=0).count() == 0
    assert scan.scan(df, event_time="at", start=T(2025, 1, 2, 1)).count() == 2
    assert scan.scan(df, event_time="at", start=T(2025, 1, 1, 1), end=T(2025, 1, 2, 1)).count() == 1
    assert scan.scan(df, event_time="at").count() == 3
    assert scan.scan(df.orderBy("id"), limit=1, event_time="at", start=T(2025, 1, 2)).count() == 0
    assert scan.preview(df, 2).count() == 2 and scan.preview(df, -1).count() == 3


def test_event_window_reaches_the_file_scan(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.createDataFrame([(1, T(2025, 1, 1))], "id int, at timestamp_ntz").write.parquet(path)
    df = scan.scan(scan.relation(spark, path), event_time="at", start=T(2025, 1, 1), end=T(2025, 1, 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThan(at" in plan


def test_sinks(spark, tmp_path, name):
    df = spark.range(1000).select("id", (F.col("id") % 4).alias("p"))
    with pytest.raises(ValueError):
        sinks.write_files(df, str(tmp_path / "x"), file_format="xls")
    with pytest.raises(ValueError):
        sinks.writer(df, bucket_by=["id"])
    sinks.write_table(df, name, bucket_by=["id"], buckets=4, location=str(tmp_path / "b"))
    assert len(spark.table(name).inputFiles()) == 4  # one file per bucket
    joined = spark.table(name).join(spark.table(name).withColumnRenamed("p", "q"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    bucket = partitions.hash_bucket("id", 4)
    per_file = spark.table(name).select(F.input_file_name().alias("f"), bucket.alias("b")).distinct()
    assert per_file.count() == 4


def test_layouts(spark, tmp_path):
    df = spark.range(4000).select(((F.col("id") * 7919) % 1000).alias("a"), ((F.col("id") * 104729) % 997).alias("b"))
    sinks.write_files(sinks.sorted_layout(df, ["a"], 4), str(tmp_path / "s"))
    written = spark.read.parquet(str(tmp_path / "s"))
    spans = written.groupBy(F.input_file_name()).agg(F.min("a").alias("lo"), F.max("a").alias("hi")).collect()
    spans = sorted((r.lo, r.hi) for r in spans)
    assert written.count() == 4000 and len(spans) == 4 and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    hot = spark.range(4000).select(F.lit(1).alias("k"), "id")
    parts = sinks.sorted_layout(hot, ["k"], 4).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts == 4  # one key over all files
    sinks.write_files(sinks.interleaved_layout(df, ["a", "b"], levels=3, parts=16), str(tmp_path / "z"))
    back = spark.read.parquet(str(tmp_path / "z"))
    width = back.groupBy(F.input_file_name()).agg((F.max("b") - F.min("b")).alias("w")).agg(F.avg("w")).first()[0]
    assert back.count() == 4000 and width < 600
    sinks.write_files(sinks.sorted_layout(df, ["a", "b"], 16), str(tmp_path / "c"))
    ranges = [sinks.file_ranges(spark.read.parquet(str(tmp_path / d)), ["a", "b"]) for d in "zc"]
    assert [r.agg(F.sum("n")).first()[0] for r in ranges] == [4000, 4000]
    few, all_ = (sinks.files_read(r, "b", 0, 100) for r in ranges)
    assert few <= 8 and all_ == ranges[1].count() == 16
    assert sinks.files_read(ranges[1], "a", 0, 100) <= 4 and sinks.files_read(ranges[1], "a", 2000, 3000) == 0
    assert sinks.distributed(df, "even").count() == sinks.distributed(df, "key", ["a"]).count() == 4000
    with pytest.raises(ValueError):
        sinks.distributed(df, "all")


def test_partition_transforms(spark):
    df = spark.createDataFrame([(T(2024, 3, 5, 7, 8), -3), (T(2024, 3, 31, 23), 17)], "at timestamp_ntz, n int")
    assert rows(df.select(partitions.range_bucket("n", 0, 10))) == [(-10,), (10,)]
    assert rows(df.select(partitions.time_partition("at", "month"))) == [(T(2024, 3, 1),)] * 2
    assert partitions.ingestion_partition(df, "at").columns == ["n", "_partition_time"]
    with pytest.raises(ValueError):
        partitions.time_partition("at", "week")
    with pytest.raises(ValueError):
        partitions.copy_sources(df, mode="merge")


def test_publish_replaces_and_recovers(spark, name):
    publish.replace_table(spark.range(3), name)
    first = publish.table_location(spark, name)
    publish.replace_table(spark.table(name).filter("id > 0"), name)
    assert rows(spark.table(name)) == [(1,), (2,)] and publish.table_location(spark, name) != first
    assert spark.catalog.tableExists(f"{name}__backup") is False
    # An interrupted publish left only the backup.
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__backup")
    assert publish.table_exists(spark, name) and rows(spark.table(name)) == [(1,), (2,)]
    spark.sql(f"CREATE VIEW {name}_w AS SELECT 1 AS id")
    publish.replace_table(spark.range(3), f"{name}_w")
    assert spark.table(f"{name}_w").count() == 3 and not publish.is_view(spark, f"{name}_w")


def test_materialized_table(spark, name):
    spark.range(3).createOrReplaceTempView(f"{name}_src")
    mv = MaterializedTable(name, lambda s: s.table(f"{name}_src"), {"a": 1})
    assert mv.refresh(spark) == "create"
    spark.range(5).createOrReplaceTempView(f"{name}_src")
    assert spark.table(name).count() == 3
    assert mv.refresh(spark) == "refresh" and spark.table(name).count() == 5
    changed = MaterializedTable(name, mv.build, {"a": 2})
    with pytest.raises(ValueError):
        changed.refresh(spark, on_config_change="fail")
    assert changed.refresh(spark, on_config_change="continue") == "skip"
    assert changed.refresh(spark) == "replace" and changed.refresh(spark, full_refresh=True) == "replace"
    with pytest.raises(ValueError):
        mv.refresh(spark, on_config_change="maybe")


def test_following_table(spark, name):
    lag, start = dt.timedelta(hours=1), T(2024, 1, 1)
    spark.range(3).createOrReplaceTempView(f"{name}_src")
    build = lambda s: s.table(f"{name}_src")
    table = FollowingTable(
        name, build, lag, refresh_mode="incremental", watermark="id", lookback=2, loading=Load(unique_key="id")
    )
    assert table.refresh_if_due(spark, start) == "create"
    spark.range(6).createOrReplaceTempView(f"{name}_src")
    assert table.refresh_if_due(spark, start + lag / 2) == "skip"
    assert table.refresh_if_due(spark, start + lag) == "incremental" and spark.table(name).count() == 6
    full = FollowingTable(f"{name}_f", build, lag, refresh_mode="full", initialize="on_schedule")
    full.create(spark, start)
    assert spark.table(f"{name}_f").count() == 0
    assert full.refresh_if_due(spark, start) == "full" and spark.table(f"{name}_f").count() == 6
    wrongs = [{"refresh_mode": "x"}, {"initialize": "x"}, {"refresh_mode": "incremental"}]
    wrongs += [{"refresh_mode": "incremental", "watermark": "id", "loading": Load(unique_key="id")}]
    wrongs += [{"refresh_mode": "incremental", "watermark": "id", "lookback": 1}]
    for wrong in wrongs:
        with pytest.raises(ValueError):
            FollowingTable(name, build, lag, **wrong)


def test_models(spark, name):
    context = Context(spark, name, {"numbers": spark.range(4), "built": lambda s: s.range(2)})
    assert run_model(lambda c: c.ref("numbers").filter("id > 1"), context).count() == 2
    assert run_model(lambda c: pd.DataFrame({"a": [1, 2]}), context).count() == 2
    assert run_model(lambda c: c.ref("built").pandas_api(), context).count() == 2
    assert run_model(lambda c: c.new_rows(c.ref("numbers"), "id"), context).count() == 4
    publish.replace_table(spark.range(3), name)
    assert run_model(lambda c: c.new_rows(c.ref("numbers"), "id"), context).count() == 1
    with pytest.raises(TypeError):
        run_model(lambda c: 3, context)


def test_scratch_folder_is_the_sessions(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    staged = stage(spark.range(5))
    assert staged.frame.count() == 5 and staged.path.startswith(scratch_root(spark))


# -- streams ----------------------------------------------------------------------------------------------------

EVENTS = "id int, user int, at timestamp_ntz, v int"


def _deliver(spark, path, events):
    spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_append_stream_is_exactly_once(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / d) for d in ("in", "out", "cp"))
    _deliver(spark, source, [(1, 1, T(2024, 1, 1), 1)])
    run = lambda: streams.append_stream(streams.file_stream(spark, source), sink, checkpoint).awaitTermination()
    run()
    run()
    assert spark.read.parquet(sink).count() == 1
    _deliver(spark, source, [(2, 1, T(2024, 1, 2), 1)])
    run()
    assert spark.read.parquet(sink).count() == 2


def test_upsert_stream(spark, tmp_path, name):
    source = str(tmp_path / "in")
    _deliver(spark, source, [(1, 1, T(2024, 1, 1), 1), (2, 1, T(2024, 1, 2), 2), (3, 2, T(2024, 1, 1), 3)])
    cfg = Load(unique_key="user", partition_by=["bucket"])

    def run(checkpoint):
        stream = streams.file_stream(spark, source, 1).withColumn("bucket", partitions.hash_bucket("user", 3))
        streams.upsert_stream(stream, name, cfg, ["at"], str(tmp_path / checkpoint)).awaitTermination()
        return rows(spark.table(name), "user", "v")

    assert run("a") == [(1, 2), (2, 3)]
    _deliver(spark, source, [(4, 2, T(2024, 1, 5), 9)])
    assert run("a") == [(1, 2), (2, 9)]
    assert run("b") == [(1, 2), (2, 9)]  # everything again from a new checkpoint: same content
    with pytest.raises(ValueError):
        streams.upsert_stream(streams.file_stream(spark, source), name, Load(), ["at"], str(tmp_path / "c"))
    with pytest.raises(ValueError):  # without partitions every micro-batch would rewrite the table
        streams.upsert_stream(streams.file_stream(spark, source), name, Load(unique_key="user"), ["at"], str(tmp_path / "c"))


def test_windowed_stream_recomputes_late_windows(spark, tmp_path, name):
    source = str(tmp_path / "in")

    def per_day(df):
        return df.groupBy("window_start").agg(F.sum("v").alias("v"))

    def run():
        streams.windowed_stream(
            streams.file_stream(spark, source), lambda s: s.read.parquet(source), name, "at", "day", per_day,
            str(tmp_path / "cp"),
        ).awaitTermination()
        return rows(spark.table(name), "window_start", "v")

    _deliver(spark, source, [(1, 1, T(2024, 1, 1, 5), 1), (2, 1, T(2024, 1, 3), 2)])
    assert run() == [(T(2024, 1, 1), 1), (T(2024, 1, 3), 2)]
    _deliver(spark, source, [(3, 1, T(2024, 1, 1, 9), 10), (4, 1, T(2024, 1, 2), 4)])
    assert run() == [(T(2024, 1, 1), 11), (T(2024, 1, 2), 4), (T(2024, 1, 3), 2)]


def test_tumbling_drops_late_rows(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        windows = streams.tumbling(
            streams.file_stream(spark, source), "at", "1 hour", "10 minutes", ["user"], {"v": F.sum("v")}
        )
        streams.append_stream(windows, sink, str(tmp_path / "cp")).awaitTermination()
        return rows(spark.read.schema(windows.schema).parquet(sink), "window_start", "v")

    _deliver(spark, source, [(1, 1, T(2024, 1, 1, 0, 5), 1), (2, 1, T(2024, 1, 1, 1, 5), 2), (3, 1, T(2024, 1, 1, 3), 4)])
    assert run() == [(T(2024, 1, 1, 0), 1), (T(2024, 1, 1, 1), 2)]
    _deliver(spark, source, [(4, 1, T(2024, 1, 1, 0, 6), 100), (5, 1, T(2024, 1, 1, 5), 1)])
    assert run() == [(T(2024, 1, 1, 0), 1), (T(2024, 1, 1, 1), 2), (T(2024, 1, 1, 3), 4)]


def test_history_stream(spark, tmp_path, name):
    source = str(tmp_path / "in")
    cfg = Snapshot("user", timestamp_strategy("at"))

    def run():
        stream = streams.file_stream(spark, source, 1)
        streams.history_stream(stream, name, cfg, [F.desc("at")], str(tmp_path / "cp")).awaitTermination()
        return rows(read_history(spark, name), "user", "v", "valid_to")

    _deliver(spark, source, [(1, 1, T(2024, 1, 1), 1), (2, 1, T(2024, 1, 2), 2), (3, 2, T(2024, 1, 1), 3)])
    first = [(1, 1, T(2024, 1, 2)), (1, 2, None)]
    assert run() == [*first, (2, 3, None)]
    _deliver(spark, source, [(4, 2, T(2024, 1, 5), 9), (5, 2, T(2024, 1, 7), 10), (6, 2, T(2024, 1, 6), 11)])
    assert run() == [*first, (2, 10, None), (2, 11, T(2024, 1, 7)), (2, 3, T(2024, 1, 5)), (2, 9, T(2024, 1, 6))]
    with pytest.raises(ValueError):
        streams.history_stream(
            streams.file_stream(spark, source), name, Snapshot("user", check_strategy("all"), hard_deletes="invalidate"),
            [], str(tmp_path / "x"),
        )



"""Merges that rewrite only the files holding a row they change."""

import os

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_recovery import Killed, killing

from tidemark.plans import filewise, load as loading, partitions
from tidemark.plans.filewise import FileSwap
from tidemark.plans.load import Load, load
from tidemark.plans.publish import replace_table, table_location
from tidemark.sources.sinks import sorted_layout

BY_FILE = Load(unique_key="id", rewrite="files")


def big(spark, n=4000, files=20):
    return sorted_layout(spark.range(n).select("id", F.lit(0).alias("v"), (F.col("id") % 7).cast("string").alias("s")), ["id"], files)


def data_files(spark, name):
    place = table_location(spark, name).removeprefix("file:")
    return {f for f in os.listdir(place) if not f.startswith((".", "_"))}


def left_over(spark, name):
    place = table_location(spark, name).removeprefix("file:") + f"/{partitions.PUBLISHED}"
    return [f for d, _, fs in os.walk(place) for f in fs] if os.path.isdir(place) else []


def test_ten_keys_rewrite_few_files(spark, name):
    replace_table(big(spark), name)
    before = data_files(spark, name)
    batch = spark.range(1000, 1010).select("id", F.lit(9).alias("v"), F.lit("new").alias("s"))
    load(batch, name, BY_FILE)
    after = data_files(spark, name)
    assert len(before) == 20 and len(before - after) <= 2  # the others are the very same files
    assert spark.table(name).count() == 4000
    assert rows(spark.table(name).filter("v = 9"), "id", "s") == [(i, "new") for i in range(1000, 1010)]
    assert left_over(spark, name) == []


def test_inserts_touch_no_file_and_rules_count_once(spark, name):
    cfg = Load(unique_key="id", rewrite="files", rules={"v": "sum"})
    replace_table(big(spark), name)
    before = data_files(spark, name)
    load(spark.createDataFrame([(5000, 1, "x"), (None, 2, "y")], "id long, v int, s string"), name, cfg)
    assert before <= data_files(spark, name) and spark.table(name).count() == 4002
    for _ in range(2):
        load(spark.createDataFrame([(5000, 1, "x"), (3, 5, "z")], "id long, v int, s string"), name, cfg)
    assert rows(spark.table(name).filter("v > 0"), "id", "v") == [(3, 10), (5000, 3), (None, 2)]


def test_same_rows_as_a_whole_rewrite(spark, name):
    batch = spark.createDataFrame([(3, 1, "a"), (77, 2, "b"), (3999, 3, "c"), (9999, 4, "d")], "id int, v int, s string")
    for i, settings in enumerate(
        [
            dict(strategy="delete+insert"), dict(predicates="target.v = 0 and target.id < 100"), dict(update_columns=["v"]),
            dict(delete_condition="batch.v = 2"), dict(by_source="delete", by_source_condition="target.id between 50 and 60"),
            dict(by_source={"v": "target.v - 1"}, by_source_condition="target.s = '3'"),
        ]
    ):
        for kind in ("files", "table"):
            replace_table(big(spark), f"{name}_{kind}_{i}")
            load(batch, f"{name}_{kind}_{i}", Load(unique_key="id", rewrite=kind, **settings))
        assert rows(spark.table(f"{name}_files_{i}")) == rows(spark.table(f"{name}_table_{i}"))


@pytest.mark.parametrize(
    "step, when", [("begin", "before"), ("write", "after"), ("record", "after"), ("repoint", "within"), ("commit", "after")]
)
def test_interrupted(spark, name, monkeypatch, step, when):
    cfg = Load(unique_key="id", rewrite="files", rules={"v": "sum"})
    replace_table(big(spark), name)
    batch = spark.createDataFrame([(3, 5, "z"), (3999, 1, "y"), (7777, 1, "n")], "id long, v int, s string")
    if when == "within":
        real, state = FileSwap.repoint, []

        def half(self, moves):
            if state:
                return real(self, moves)
            state.append(1)
            partitions.LIVE.clear()
            real(self, (moves[0][:1], moves[1][:1]))
            raise Killed

        monkeypatch.setattr(FileSwap, "repoint", half)
    else:
        monkeypatch.setattr(partitions, "Publication", FileSwap)
        monkeypatch.setattr("test_recovery.Publication", FileSwap)
        killing(monkeypatch, step, when)
    with pytest.raises(Killed):
        load(batch, name, cfg, run_id="a")
    load(batch, name, cfg, run_id="a")
    assert rows(spark.table(name).filter("v > 0"), "id", "v") == [(3, 5), (3999, 1), (7777, 1)]
    assert spark.table(name).count() == 4001 and left_over(spark, name) == []


def test_tables_that_cannot_be_are_rewritten_whole(spark, name, monkeypatch):
    replace_table(big(spark), name, bucket_by=["id"], buckets=4)
    batch = spark.range(3).select("id", F.lit(1).alias("v"), F.lit("q").alias("s"))
    load(batch, name, BY_FILE)
    assert spark.table(name).filter("s = 'q'").count() == 3 and spark.table(name).count() == 4000
    replace_table(big(spark), f"{name}_b")
    monkeypatch.setattr(filewise, "MAX_FILES", 0)
    load(batch, f"{name}_b", BY_FILE)
    assert spark.table(f"{name}_b").filter("s = 'q'").count() == 3
    with pytest.raises(ValueError):
        loading.validate(Load(unique_key="id", rewrite="rows"))

"""Loads in parts by partitions and buckets, partition values from the catalog, and evolution inside maps."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F, types as T

from tidemark.operators.partitions import hash_bucket
from tidemark.operators.schema import reconcile
from tidemark.plans import load as loading
from tidemark.plans.load import Load, load, load_in_parts
from tidemark.plans.partitions import largest_partition
from tidemark.plans.publish import replace_table, shape

BY = dict(bucket_by=["id"], buckets=4)


def frame(spark, first=0, n=60, v=0):
    return spark.range(first, first + n).select("id", F.lit(v).alias("v"), (F.col("id") % 3).cast("int").alias("p"))


def watched(monkeypatch):
    """Partitions and buckets that each part opens."""
    seen = []
    real = loading.load

    def watching(batch, *args, **kwargs):
        seen.append(batch.select("p", hash_bucket(["id"], 4)).distinct().count())
        return real(batch, *args, **kwargs)

    monkeypatch.setattr(loading, "load", watching)
    return seen


@pytest.mark.parametrize("most", [1, 2, 5, 100])
def test_no_part_opens_more_than_it_may(spark, name, monkeypatch, most):
    cfg = Load(strategy="append", partition_by=["p"])
    replace_table(frame(spark, n=0), name, partition_by=["p"], bucket_by=["id"], buckets=4)
    seen = watched(monkeypatch)
    loads = load_in_parts(frame(spark), name, cfg, most, **BY)
    assert loads == len(seen) == -(-12 // most) and max(seen) <= most and sum(seen) == 12
    assert rows(spark.table(name)) == rows(frame(spark))
    assert shape(spark, name).buckets == 4


def test_overwrites_replace_a_partition_once(spark, name):
    old, new = frame(spark, v=1), frame(spark, first=30, n=60, v=2).filter("p <> 2")
    dynamic = Load(strategy="insert_overwrite", partition_by=["p"])
    load(old, name, dynamic)
    load_in_parts(new, name, dynamic, 1, **BY)
    assert rows(spark.table(name)) == rows(old.filter("p = 2").union(new))
    static = Load(strategy="insert_overwrite", partition_by=["p"], overwrite_values=[0, 1, 2])
    load_in_parts(new.filter("p = 0"), name, static, 1, **BY)
    assert rows(spark.table(name)) == rows(new.filter("p = 0"))


def test_merges_by_parts(spark, name):
    cfg = Load(unique_key="id", partition_by=["p"])
    load(frame(spark), name, cfg)
    load_in_parts(frame(spark, first=50, n=20, v=7), name, cfg, 2, **BY)
    want = rows(frame(spark, n=50).union(frame(spark, first=50, n=20, v=7)))
    assert rows(spark.table(name)) == want
    spread = frame(spark, n=1).union(frame(spark, n=1).withColumn("p", F.lit(2)))
    with pytest.raises(ValueError):
        load_in_parts(spread, name, cfg, 2, **BY)
    with pytest.raises(ValueError):
        load_in_parts(frame(spark), name, cfg, 2, bucket_by=["id"])


# -- the largest partition ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "kind, values, top",
    [
        ("int", [9, 10, None, 2], 10),
        ("date", ["2024-02-01", "2023-12-31", None], dt.date(2024, 2, 1)),
        ("string", ["a/b=c +%", "Z", ""], "a/b=c +%"),
        ("timestamp_ntz", ["2024-01-01 10:00:00", "2024-01-01 9:00:00"], dt.datetime(2024, 1, 1, 10)),
        ("decimal(10,2)", ["9.50", "10.25"], __import__("decimal").Decimal("10.25")),
    ],
)
def test_largest_partition_is_compared_by_type(spark, name, kind, values, top):
    df = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(values)], "id int, p string")
    replace_table(df.withColumn("p", F.col("p").cast(kind)), name, partition_by=["p"])
    assert largest_partition(spark, name, "p") == top


def test_largest_partition_reads_no_data(spark, name, tmp_path):
    replace_table(spark.range(10).withColumn("q", F.lit("x")).withColumn("p", F.col("id") % 4), name, partition_by=["p", "q"])
    place = shape(spark, name).location.removeprefix("file:")
    import pathlib

    for file in pathlib.Path(place).rglob("*.parquet"):
        file.write_bytes(b"unreadable")
    assert largest_partition(spark, name, "p") == 3 and largest_partition(spark, name, "q") == "x"
    assert largest_partition(spark, name, "p", F.col("p") < 3) == 2
    assert largest_partition(spark, name, "p", F.col("p") > 3) is None
    with pytest.raises(ValueError):
        largest_partition(spark, name, "id")


# -- maps ---------------------------------------------------------------------------------------------------------


def test_structs_inside_maps_evolve(spark):
    old = spark.createDataFrame([(1, {"a": (1,), "b": None}), (2, None)], "id int, m map<string,struct<x:int>>")
    new = spark.createDataFrame(
        [(3, {"c": ("s", 5)})], "id int, m map<string,struct<y:string,x:int>>"
    )
    target, batch = reconcile(old, new, "append_new_columns")
    both = target.unionByName(batch)
    kind = both.schema["m"].dataType
    assert isinstance(kind, T.MapType) and kind.valueType.fieldNames() == ["x", "y"]
    got = {r.id: None if r.m is None else {k: v and tuple(v) for k, v in r.m.items()} for r in both.collect()}
    assert got == {1: {"a": (1, None), "b": None}, 2: None, 3: {"c": (5, "s")}}
    _, same = reconcile(old, new, "ignore")
    assert {k: tuple(v) for k, v in same.collect()[0].m.items()} == {"c": (5,)}


def test_maps_of_arrays_of_structs(spark, name):
    deep = "id int, m map<int,array<struct<x:int>>>"
    load(spark.createDataFrame([(1, {7: [(1,), (2,)]})], deep), name, Load())
    wider = spark.createDataFrame([(2, {8: [(3, "n")]})], "id int, m map<int,array<struct<x:int,w:string>>>")
    load(wider, name, Load(on_schema_change="append_new_columns"))
    got = {r.id: {k: [tuple(x) for x in v] for k, v in r.m.items()} for r in spark.table(name).collect()}
    assert got == {1: {7: [(1, None), (2, None)]}, 2: {8: [(3, "n")]}}

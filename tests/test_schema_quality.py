import datetime as dt
import decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F, types as T

from tidemark.operators import compare, freshness, quality, schema, structs
from tidemark.operators.schema import Constraint, SchemaMismatch
from tidemark.plans.load import Load, load

DDL = T.StructType.fromDDL


def test_diff_and_policies(spark):
    target = DDL("id int, field1 string, field2 string, field3 int")
    source = DDL("ID int, field1 varchar(20), field3 bigint, field4 string")
    change = schema.diff(source, target)
    assert [f.name for f in change.added] == ["field4"] and [f.name for f in change.removed] == ["field2"]
    assert [(n, o.simpleString(), w.simpleString()) for n, o, w in change.retyped] == [("field3", "int", "bigint")]
    assert schema.evolved_schema(target, source, "append_new_columns").names == [*target.names, "field4"]
    assert schema.evolved_schema(target, source, "sync_all_columns").names == ["id", "field1", "field3", "field4"]
    for policy in ("fail", "ignore", "whatever"):
        with pytest.raises(SchemaMismatch):
            schema.evolved_schema(target, source, policy)
    assert schema.normalise_policy("whatever") == "ignore"
    assert schema.evolved_schema(target, target, "fail") == target
    with pytest.raises(SchemaMismatch):
        schema.evolved_schema(target, DDL(""), "sync_all_columns")
    assert schema.evolved_schema(target, DDL(""), "append_new_columns") == target


def test_nested_types_merge(spark):
    old = DDL("id int, s struct<a: int, n: struct<x: int>>, l array<struct<p: int>>")
    new = DDL("id int, s struct<n: struct<y: string, x: int>, b: string>, l array<struct<q: int, p: int>>")
    merged = schema.evolved_schema(old, new, "append_new_columns")
    assert merged["s"].dataType.simpleString() == "struct<a:int,n:struct<x:int,y:string>,b:string>"
    assert merged["l"].dataType.simpleString() == "array<struct<p:int,q:int>>"


def test_conform_keeps_null_structs(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'a', 'x') AS s, array(named_struct('p', 1)) AS l UNION ALL SELECT null, null")
    got = structs.conform_frame(df, DDL("l array<struct<q: int, p: bigint>>, s struct<a: string, b: int, c: int>, z int"))
    assert got.schema.simpleString() == "struct<l:array<struct<q:int,p:bigint>>,s:struct<a:string,b:int,c:int>,z:int>"
    first, second = got.orderBy(F.col("s").isNull()).collect()
    assert first.s == ("x", 1, None) and first.l == [(None, 1)] and (second.s, second.l) == (None, None)


def test_flatten_and_nest_are_inverse(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 2, 'y', named_struct('z', 3)) AS s")
    flat = structs.flatten(df)
    assert flat.columns == ["id", "s.x", "s.y.z"]
    assert structs.nest(flat).first() == df.first()
    with pytest.raises(ValueError):
        structs.nest(spark.createDataFrame([(1, 2)], ["a", "a.b"]))


@pytest.mark.parametrize("policy", ["append_new_columns", "sync_all_columns", "fail", "ignore"])
@pytest.mark.parametrize("partition_by", [[], ["id"]])
def test_load_evolves_the_table(spark, name, policy, partition_by):
    cfg = Load(strategy="append", on_schema_change=policy, partition_by=partition_by)
    load(spark.createDataFrame([(1, "a", 1)], "id int, f1 string, f2 int"), name, cfg)
    batch = spark.createDataFrame([(2, 7, "x")], "id int, f2 bigint, f3 string")
    if policy in ("fail", "ignore"):
        with pytest.raises(SchemaMismatch):
            load(batch, name, cfg)
        return
    load(batch, name, cfg)
    table = spark.table(name)
    if policy == "append_new_columns":
        assert rows(table, "id", "f1", "f2", "f3") == [(1, "a", 1, None), (2, None, 7, "x")]
    else:
        assert sorted(table.columns) == ["f2", "f3", "id"]
        assert rows(table, "id", "f2", "f3") == [(1, 1, None), (2, 7, "x")]


def test_load_adds_nested_fields(spark, name):
    cfg = Load(unique_key="id", on_schema_change="append_new_columns")
    load(spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s"), name, cfg)
    load(spark.sql("SELECT 2 AS id, named_struct('b', 'x', 'a', 2) AS s"), name, cfg)
    assert rows(spark.table(name), "id", "s.a", "s.b") == [(1, 1, None), (2, 2, "x")]


def test_contract(spark):
    df = spark.createDataFrame([("red", 1, "2024-01-01")], "color string, id int, date_day string")
    contract = DDL("id int, color varchar(10), date_day string")
    assert schema.enforce_contract(df, contract).columns == ["id", "color", "date_day"]
    for wrong in ("id string, color string, date_day string", "id int, color string", "id int, color string, date_day string, x int"):
        with pytest.raises(SchemaMismatch, match="contract"):
            schema.enforce_contract(df, DDL(wrong))


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, None, -1), (3, "zz", 4)], "id int, c string, n int")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    rules = [
        Constraint("not_null", ("c",)),
        Constraint("check", condition="n > 0", name="positive"),
        Constraint("primary_key", ("id",)),
        Constraint("unique", ("c",)),
        Constraint("foreign_key", ("c",), parent=parent, parent_columns=("k",)),
    ]
    assert rows(schema.constraint_violations(df, rules)) == [
        ("foreign_key_c", 1), ("not_null_c", 1), ("positive", 1), ("primary_key_id_null", 1),
        ("primary_key_id_repeated", 1), ("unique_c", 0),
    ]
    with pytest.raises(SchemaMismatch):
        schema.enforce_constraints(df, rules)
    schema.enforce_constraints(df, [rules[3]])
    with pytest.raises(ValueError):
        schema.constraint_violations(df, [Constraint("exclude")])


def test_set_operations(spark):
    a, b = (spark.createDataFrame([(i,) for i in ids], "id int") for ids in ((1, 2, 3, 1), (3, 4, 5)))
    assert rows(compare.except_rows(a, b)) == [(1,), (2,)] and rows(compare.intersect_rows(a, b)) == [(3,)]
    assert compare.union_all(a, b).count() == 7
    assert compare.rel_diff(a, b).first() == (1, 4)
    assert compare.rel_diff(a, b, multiset=True).first() == (1, 5)
    assert compare.rel_diff(a, a.limit(0)).first() == (4, 3) and compare.rel_diff(a.limit(0), b.limit(0)).first() == (0, 0)
    assert not compare.same_rows(a, a.distinct()) and compare.same_rows(a, a)
    nulls = spark.createDataFrame([(None,)], "id int")
    assert compare.rel_diff(nulls, nulls).first() == (0, 0)
    with pytest.raises(ValueError):
        compare.rel_diff(a, b.withColumnRenamed("id", "x"))


def test_generic_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "a")], "id int, v string")
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert rows(quality.not_null(df, "v", whole_rows=True)) == [(2, None)] and quality.not_null(df, "id").columns == ["id"]
    assert rows(quality.accepted_values(df, "v", ["a", "b"])) == [("c", 1)]
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    assert rows(quality.relationships(df, "v", parent, "p")) == [("b",), ("c",)]
    assert quality.unique(quality.tested(df, "v <> 'a'"), "id").count() == 0


def test_verdicts(spark, name):
    failing = spark.range(5)
    assert quality.evaluate(failing).first() == (5, True, True)
    assert quality.evaluate(failing, limit=2, warn_if="> 1", error_if="> 2").first() == (2, True, False)
    assert quality.evaluate(failing, fail_calc="sum(id)", error_if=">= 11").first() == (10, True, False)
    assert quality.evaluate(failing.limit(0)).first() == (0, False, False)
    for store_as in ("table", "view", "ephemeral"):
        verdict = quality.evaluate_stored(failing, f"{name}_{store_as}", store_as, warn_if="> 4")
        assert verdict.first() == (5, True, True)
    assert spark.table(f"{name}_table").count() == 5
    with pytest.raises(ValueError):
        quality.evaluate_stored(failing, name, "materialized")


def test_fixtures_and_unit_tests(spark):
    wanted = DDL(
        "i int, d decimal(10,2), s string, b boolean, day date, t timestamp_ntz, a array<int>, m map<string,string>, "
        "r struct<x: int, y: string>"
    )
    given = quality.fixture(
        spark,
        [
            {"I": 1, "d": "1.50", "s": "a" * 300, "b": True, "day": "2020-01-02", "t": "2013-11-03 00:00:00",
             "a": [1, 2], "m": {"k": "v"}, "r": {"x": 1, "y": "z"}},
            {"s": "only", "d": decimal.Decimal("2.25")},
        ],
        wanted,
    )
    assert given.schema.simpleString() == wanted.simpleString()
    first = given.filter("i = 1").first()
    assert (first.d, len(first.s), first.day, first.t) == (decimal.Decimal("1.50"), 300, dt.date(2020, 1, 2), dt.datetime(2013, 11, 3))
    assert (first.a, first.m, first.r) == ([1, 2], {"k": "v"}, (1, "z"))
    assert quality.fixture(spark, [], wanted).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        quality.fixture(spark, [{"nope": 1}], wanted)

    actual = given.groupBy("s").agg(F.count("i").alias("n"), F.max("d").alias("unchecked"))
    good = quality.fixture(spark, [{"s": "a" * 300, "n": 1}, {"s": "only", "n": 0}], DDL("s string, n bigint"))
    assert quality.unit_test(actual, good).isEmpty()
    bad = quality.fixture(spark, [{"s": "only", "n": 3}, {"s": "a" * 300, "n": 1}], DDL("s string, n bigint"))
    assert rows(quality.unit_test(actual, bad), "s", "n", "side", "copies") == [
        ("only", 0, "actual", 1), ("only", 3, "expected", 1),
    ]


def test_freshness(spark, tmp_path):
    now = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),), (dt.datetime(2024, 1, 1, 23, 59, 59),)], "t timestamp_ntz")
    assert freshness.by_field(df, "t", now).first() == (dt.datetime(2024, 1, 1, 23, 59, 59), now, 1.0)
    assert freshness.by_field(df, "t", now, "t < timestamp_ntz'2024-01-01 13:00:00'").first()["age"] == 12 * 3600.0
    assert freshness.by_field(df.limit(0), "t", now).first()["max_loaded_at"] == dt.datetime(1, 1, 1)
    with pytest.raises(ValueError):
        freshness.by_query(spark.range(1).selectExpr("id", "id AS b"), now)
    df.write.parquet(str(tmp_path / "f"))
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(seconds=60)
    assert 0 < freshness.by_files(spark, str(tmp_path / "f"), later, "*.parquet").first()["age"] < 600

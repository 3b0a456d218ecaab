import datetime as dt

import pandas as pd
import pytest
from helpers import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import aggregates, arrays, dates, text, types, udf
from tidemark.operators import generate

T = dt.datetime


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def moment(value):
    return F.lit(None).cast("timestamp_ntz") if value is None else dates.as_time(value)


@pytest.mark.parametrize(
    "start, end, part, expected",
    [
        (T(2018, 1, 1, 1), T(2018, 1, 2, 1), "day", 1),
        (T(2018, 1, 1, 1), T(2018, 2, 1, 1), "month", 1),
        (T(2018, 1, 1, 1), T(2019, 1, 1, 1), "year", 1),
        (T(2018, 1, 1, 1), T(2018, 1, 1, 2), "hour", 1),
        (T(2018, 1, 1, 1), T(2018, 1, 1, 2, 1), "minute", 61),
        (T(2018, 1, 1, 1), T(2018, 1, 1, 2, 0, 1), "second", 3601),
        (T(2019, 12, 31), T(2019, 12, 27), "week", -1),
        (T(2019, 12, 31), T(2019, 12, 30), "week", 0),
        (T(2019, 12, 31), T(2020, 1, 2), "week", 0),
        (T(2019, 12, 31), T(2020, 1, 6), "week", 1),
        (T(2018, 1, 31), T(2018, 2, 28), "month", 1),
        (T(2018, 1, 1), None, "day", None),
        (None, T(2018, 1, 1), "hour", None),
        (T(1969, 12, 31, 23), T(1970, 1, 1, 1), "day", 1),
        (T(1969, 12, 30), T(1970, 1, 4), "week", 1),
    ]
    + [
        (T(1999, 12, 31, 23, 59, 59, 999999), T(2000, 1, 3 if part == "week" else 1), part, 1)
        for part in ("microsecond", "millisecond", "second", "minute", "hour", "day", "week", "month", "quarter", "year")
        if part != "microsecond"
    ]
    + [(T(1999, 12, 31, 23, 59, 59, 999999), T(2000, 1, 1), "microsecond", 1)],
)
def test_datediff_counts_boundaries(spark, start, end, part, expected):
    assert one(spark, dates.datediff(moment(start), moment(end), part)) == expected


@settings(max_examples=15, deadline=None)
@given(
    a=st.datetimes(T(1900, 1, 1), T(2100, 1, 1)),
    b=st.datetimes(T(1900, 1, 1), T(2100, 1, 1)),
    part=st.sampled_from(["second", "hour", "day", "week", "month", "quarter", "year"]),
)
def test_datediff_is_antisymmetric(spark, a, b, part):
    row = spark.range(1).select(
        dates.datediff(moment(a), moment(b), part).alias("there"),
        dates.datediff(moment(b), moment(a), part).alias("back"),
    ).first()
    assert row["there"] == -row["back"]


def test_dateadd(spark):
    noon = moment(T(2018, 1, 1, 1))
    assert one(spark, dates.dateadd("day", 1, noon)) == T(2018, 1, 2, 1)
    assert one(spark, dates.dateadd("month", 1, noon)) == T(2018, 2, 1, 1)
    assert one(spark, dates.dateadd("year", 1, noon)) == T(2019, 1, 1, 1)
    assert one(spark, dates.dateadd("hour", 1, noon)) == T(2018, 1, 1, 2)
    assert one(spark, dates.dateadd("month", 1, moment(T(2019, 1, 31)))) == T(2019, 2, 28)
    assert one(spark, dates.dateadd("day", 1, moment(None))) is None
    with pytest.raises(ValueError):
        dates.dateadd("fortnight", 1, noon)


def test_date_trunc_and_last_day(spark):
    value = moment(T(2018, 1, 5, 12, 34, 56))
    assert one(spark, dates.date_trunc("day", value)) == T(2018, 1, 5)
    assert one(spark, dates.date_trunc("month", value)) == T(2018, 1, 1)
    assert one(spark, dates.date_trunc("hour", value)) == T(2018, 1, 5, 12)
    with pytest.raises(ValueError):
        dates.date_trunc("decade", value)
    day = moment(T(2018, 1, 2))
    assert one(spark, dates.last_day(day, "month")) == dt.date(2018, 1, 31)
    assert one(spark, dates.last_day(day, "quarter")) == dt.date(2018, 3, 31)
    assert one(spark, dates.last_day(day, "year")) == dt.date(2018, 12, 31)


def test_results_do_not_depend_on_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in New York on this day.
        gap = moment(T(2024, 3, 10, 2, 30))
        assert one(spark, dates.date_trunc("hour", gap)) == T(2024, 3, 10, 2)
        assert one(spark, dates.datediff(moment(T(2024, 3, 10)), moment(T(2024, 3, 11)), "hour")) == 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "column, expected",
    [
        (lambda: text.split_part(F.lit("a|b|c"), "|", 1), "a"),
        (lambda: text.split_part(F.lit("a|b|c"), "|", 3), "c"),
        (lambda: text.split_part(F.lit("a|b|c"), "|", -1), "c"),
        (lambda: text.split_part(F.lit("1.2.3"), ".", 2), "2"),
        (lambda: text.split_part(F.lit(None).cast("string"), "|", 1), None),
        (lambda: text.hash_text(F.lit("ab")), "187ef4436122d1cc2f40dc2b92f0eba0"),
        (lambda: text.hash_text(F.lit("")), "d41d8cd98f00b204e9800998ecf8427e"),
        (lambda: text.hash_text(F.lit(None).cast("string")), None),
        (lambda: text.position(F.lit("land"), F.lit("earth")), 0),
        (lambda: text.position(F.lit("de"), F.lit("abcdef")), 4),
        (lambda: text.right(F.lit("december"), 0), ""),
        (lambda: text.right(F.lit("december"), 4), "mber"),
        (lambda: text.length(F.lit("www.google.com/path")), 19),
        (lambda: text.concat(F.lit("a"), F.lit("")), "a"),
        (lambda: text.concat(F.lit("a"), F.lit(None).cast("string")), None),
        (lambda: text.replace(F.lit("http://google.com"), "google", "maps"), "http://maps.com"),
        (lambda: text.bool_to_text(F.lit(True)), "true"),
        (lambda: text.bool_to_text(F.lit(None).cast("boolean")), None),
        (lambda: text.escape_single_quotes(F.lit("they're")), "they''re"),
        (lambda: text.escape_single_quotes(F.lit("they're"), "backslash"), "they\\'re"),
        (lambda: text.mask_tail(F.lit("johndoe")), "jo*****"),
        (lambda: text.mask_tail(F.lit("j")), "j"),
        (lambda: types.safe_cast(F.lit("abc"), "date"), None),
        (lambda: types.safe_cast(F.lit("12"), "int"), 12),
        (lambda: arrays.array_append(arrays.array_construct([F.lit(1), F.lit(2)]), F.lit(3)), [1, 2, 3]),
        (lambda: arrays.array_concat(F.array(F.lit(1)), F.array(F.lit(2))), [1, 2]),
        (lambda: arrays.array_construct([], "string"), []),
    ],
)
def test_scalar_functions(spark, column, expected):
    assert one(spark, column()) == expected


def test_split_part_rejects_zero():
    with pytest.raises(ValueError):
        text.split_part("x", "|", 0)


def test_equals_with_nulls(spark):
    pairs = [(1, 1), (1, 2), (1, None), (None, 1), (None, None)]
    df = spark.createDataFrame(pairs, "x int, y int")
    plain, safe = types.equals(df.x, df.y), types.equals(df.x, df.y, null_safe=True)
    got = [(r.plain, r.safe) for r in df.select(plain.alias("plain"), safe.alias("safe")).collect()]
    assert got == [(True, True), (False, False), (None, False), (None, False), (None, True)]


LISTED = [
    (1, "sand", 3), (1, "clay", 1), (1, "silt", 2), (2, "9", 1), (2, "10", 2), (3, "ice", 5), (3, "ice", 4), (3, None, 6),
]


@pytest.mark.parametrize(
    "settings_, expected",
    [
        ({"delimiter": " / ", "ordered": True}, ["clay / silt / sand", "9 / 10", "ice / ice"]),
        ({"delimiter": " / ", "ordered": True, "limit": 2}, ["clay / silt", "9 / 10", "ice / ice"]),
        ({"delimiter": ";"}, ["clay;sand;silt", "10;9", "ice;ice"]),
        ({"distinct": True}, ["clay,sand,silt", "10,9", "ice"]),
        ({}, ["clay,sand,silt", "10,9", "ice,ice"]),
    ],
)
def test_listagg(spark, settings_, expected):
    df = spark.createDataFrame(LISTED, "g int, t string, o int").repartition(3)
    options = dict(settings_)
    order = F.col("o") if options.pop("ordered", False) else None
    got = aggregates.listagg(df, ["g"], F.col("t"), order_by=order, **options)
    assert rows(got) == [(i + 1, e) for i, e in enumerate(expected)]


def test_listagg_keeps_one_hot_group_whole_and_ordered(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).alias("g"), F.col("id").alias("o")
    )
    got = aggregates.listagg(df, ["g"], F.col("o"), order_by=F.col("o")).filter("g = 7").first()["listagg"]
    assert got == ",".join(str(i) for i in range(0, 20000, 3))


def test_bool_or_and_any_value(spark):
    df = spark.createDataFrame(
        [("buoy", 4, 4), ("buoy", 4, 5), ("dune", 2, 3), ("reef", 8, None), ("reef", 8, 8), ("weir", 6, None), ("weir", 6, 7)],
        "k string, a int, b int",
    )
    got = df.groupBy("k").agg(
        aggregates.bool_or(F.col("a") == F.col("b")).alias("v"), aggregates.any_value(F.col("a")).alias("s")
    )
    assert rows(got) == [("buoy", True, 4), ("dune", False, 2), ("reef", True, 8), ("weir", False, 6)]


def test_sum_positive_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 2.0), (2, -5.0), (2, 3.5)], "k int, x double")
    assert rows(df.groupBy("k").agg(aggregates.sum_positive(F.col("x")).alias("s"))) == [(1, 0.0), (2, 5.5)]


class Spread:
    """Largest minus smallest, with a state of two numbers."""

    def init(self):
        return None

    def accumulate(self, state, values):
        low, high = values.min(), values.max()
        return (low, high) if state is None else (min(low, state[0]), max(high, state[1]))

    def merge(self, left, right):
        return (min(left[0], right[0]), max(left[1], right[1]))

    def finish(self, state):
        return float(state[1] - state[0])


def test_python_aggregate_merges_partial_states(spark, monkeypatch):
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    monkeypatch.setattr(udf, "PARTIAL_GROUPS", 2)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3 + 2**60).alias("k"), F.col("id").cast("double").alias("x")
    ).repartition(7)
    got = udf.aggregate(df, ["k"], "x", Spread(), "double", "spread", spread=3)
    assert rows(got) == [(2**60 + 1, 2997.0), (2**60 + 2, 2997.0), (None, 2997.0)]
    assert got.schema["k"].dataType == df.schema["k"].dataType
    squared = udf.aggregate(spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0)], "k int, x double"), ["k"], "x",
                            udf.SumSquared(), "double", "s")
    assert rows(squared) == [(1, 36.0)]


class Calls(Spread):
    """The calls of accumulate that made a group's state, and its rows."""

    def init(self):
        return 0, 0

    def accumulate(self, state, values):
        return state[0] + 1, state[1] + len(values)

    def merge(self, left, right):
        return left[0] + right[0], left[1] + right[1]

    def finish(self, state):
        return 1000.0 * state[0] + state[1]


def test_python_aggregate_folds_sparse_groups_once(spark):
    """Groups with a row or two in every task take a call or two, not one for each task; a hot group is folded before."""
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    ids = spark.range(0, 12_000, 1, 6)
    key = F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("id") % 1000)
    got = udf.aggregate(ids.select(key.alias("k"), F.lit(1.0).alias("x")), ["k"], "x", Calls(), "double", "c").collect()
    assert len(got) == 751 and {r.c % 1000 for r in got if r.k is not None} == {12.0}
    assert all(r.c // 1000 <= 2 for r in got if r.k is not None)
    assert [(r.c // 1000, r.c % 1000) for r in got if r.k is None] == [(6.0 + 3.0, 0.0)]


def _double(price: pd.Series) -> pd.Series:
    return price * 2


def test_scalar_functions_by_name(spark):
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    udf.create_sql_function(spark, "doubled", [udf.Arg("price", "DOUBLE", "100")], "DOUBLE", "price * 2")
    assert spark.sql("SELECT doubled(5) AS a, doubled() AS b").first() == (10.0, 200.0)
    udf.create_python_function(spark, "doubled_py", _double, "double")
    assert spark.sql("SELECT doubled_py(5D) AS a").first()["a"] == 10.0
    with pytest.raises(ValueError):
        udf.create_sql_function(spark, "f", [udf.Arg("a", "INT", "1"), udf.Arg("b", "INT")], "INT", "a + b")


def test_generators(spark):
    assert rows(generate.generate_series(spark, 10)) == sorted([(i,) for i in range(1, 11)], key=lambda r: str(r[0]))
    with pytest.raises(ValueError):
        generate.generate_series(spark, 0)
    spine = generate.date_spine(spark, "day", T(2023, 9, 1), T(2023, 9, 10))
    assert rows(spine) == [(T(2023, 9, d),) for d in range(1, 10)]
    months = generate.date_spine(spark, "month", T(2023, 11, 1), T(2024, 2, 1))
    assert rows(months) == [(T(2023, 11, 1),), (T(2023, 12, 1),), (T(2024, 1, 1),)]
    with pytest.raises(ValueError):
        generate.date_spine(spark, "day", T(2023, 9, 1), T(2023, 9, 1))
    assert rows(generate.partition_range(spark, "20240228,20240301")) == [("20240228",), ("20240229",), ("20240301",)]
    assert rows(generate.partition_range(spark, "20240228")) == [("20240228",)]
    for wrong in ("20240301,20240228", "20240301,20240302,20240303"):
        with pytest.raises(ValueError):
            generate.partition_range(spark, wrong)


def test_type_families():
    from pyspark.sql import types as S

    assert [types.type_family(t) for t in (S.StringType(), S.DoubleType(), S.ShortType(), S.DecimalType(28, 6), S.DateType())] == [
        "string", "float", "integer", "numeric", None,
    ]

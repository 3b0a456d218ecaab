"""Impact-ordered search against all inner products."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import impact_search

SCHEMA = "vec_id long, embedding array<float>"


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(64 * float(np.float32(x))) for x in vector]


def brute(rows, every=20, k=20):
    vectors = [(i, whole(v)) for i, v in rows]
    vectors = [(i, v) for i, v in vectors if v is not None]
    queries = {(i, tuple(v)) for i, v in vectors if i is not None and i % every == 0}
    out = []
    for me, q in queries:
        scores = [
            (-sum(a * b for a, b in zip(q, v, strict=False)), i is None, i or 0) for i, v in vectors if i is None or i != me
        ]
        out += [(me, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(df, every=20, k=20):
    got = impact_search.search(df, df.where(f"vec_id % {every} = 0"), k)
    return sorted((tuple(r) for r in got.collect()), key=str)


def clustered(n, width, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(7)]
    return [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("block", [16, 50, 8192])
def test_equal_to_all_products(spark, monkeypatch, block):
    monkeypatch.setattr(impact_search, "BLOCK", block)
    monkeypatch.setattr(impact_search, "TIMES", 1)
    rows = clustered(300, 24)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_sets_of_queries(spark, monkeypatch):
    monkeypatch.setattr(impact_search, "QUERIES", 7)
    rows = clustered(200, 8, 5)
    assert found(spark.createDataFrame(rows, SCHEMA), every=5, k=3) == brute(rows, every=5, k=3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(40, 4, 9) + [
        (None, [1.0, 1.0, 1.0, 1.0]), (60, None), (80, [nan, 0.0, 0.0, 0.0]), (100, [inf, 0.0, 0.0, 0.0]),
        (120, [1.0, None, 0.0, 0.0]), (140, []), (160, [0.5]), (180, [0.0] * 4), (20, [0.3, -0.2, 0.1, 0.0]),
        (0, [9.0, 9.0, 9.0, 9.0]), (7, [0.1, 0.1, 0.1, 0.1]), (7, [0.1, 0.1, 0.1, 0.1]), (200, [2000000.0, -2000000.0, 1.0, 2.0]),
    ]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ties_and_few_rows(spark):
    rows = [(i, [0.25, 0.5]) for i in range(45)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert sorted(r[2] for r in got if r[0] == 0) == list(range(1, 21))
    few = rows[:3]
    assert found(spark.createDataFrame(few, SCHEMA)) == brute(few)
    assert found(spark.createDataFrame([(0, [1.0])], SCHEMA)) == []


def test_only_possible_members_are_left():
    """The proof holds, and leaves few vectors to score."""
    import pyarrow as pa

    vectors = np.array([whole(v) for _, v in clustered(2000, 32, 11)], np.int64)
    order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T.astype(np.int16))
    block = impact_search.Block(pa.array(range(2000)), vectors.astype(np.int32).tobytes(), order.tobytes(), 32)
    queries = vectors[:50]
    left = dict(impact_search.members(block, queries, np.full(50, 20), np.full(50, -(2**62))))
    assert sorted(left) == list(range(50))
    for i, query in enumerate(queries):
        scores = vectors @ query
        kth = np.sort(scores)[-20]
        assert set(np.flatnonzero(scores >= kth)) <= set(left[i])
    assert max(map(len, left.values())) < 500


@pytest.mark.parametrize("scale", [1, 300, 2_000_000])
def test_sums_beyond_floats(spark, scale):
    """Products that don't fit a float's bits are exact all the same."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-scale, scale) for _ in range(12)]) for i in range(120)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_tables_and_other_columns(spark):
    df = spark.createDataFrame(clustered(60, 6), SCHEMA)
    assert found(df.limit(0)) == []
    assert impact_search.search(df, df.limit(0)).collect() == []
    wide = df.selectExpr("*", "1 as rank", "2 as score", "3 as query_id", "4 as v", "5 as label")
    assert found(wide) == found(df)

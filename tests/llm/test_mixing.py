"""The schedule against a step-by-step earliest-deadline-first run, and the deviation at every slot."""

import math
from collections import Counter
from fractions import Fraction

import pytest

from tidemark.llm.mixing import mix

WEIGHTS = {"a": 5, "b": 3, "c": 2}


def frame(spark, sizes, extra="slot int"):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, None if source == "null" else source, 1))
            i += 1
    return spark.createDataFrame(rows, f"doc_id long, source string, {extra}")


def stream(source):
    return source if source in WEIGHTS else "*"


def simulated(blocks, quota):
    """Source and block of each slot, round by round."""
    order, done = [], Counter()
    while any(done[s] < blocks[s] for s in quota):
        m = {s: min(quota[s], blocks[s] - done[s]) for s in quota}
        total, next_ = sum(m.values()), Counter()
        for t in range(total):
            offers = [
                (math.ceil(Fraction((next_[s] + 1) * total, m[s])), i, s)
                for i, s in enumerate(quota)
                if next_[s] < m[s] and Fraction(next_[s] * total, m[s]) < t + 1
            ]
            s = min(offers)[2]
            order.append((s, done[s] + next_[s]))
            next_[s] += 1
        done.update(m)
    return order


@pytest.mark.parametrize(
    "sizes",
    [{"a": 97, "b": 41, "c": 300, "x": 20, "null": 7}, {"a": 3}, {"c": 64, "y": 1}, {"a": 50, "b": 30, "c": 20, "z": 10}],
)
def test_schedule(spark, sizes):
    df = frame(spark, sizes)
    out = mix(df, WEIGHTS, others=1, block_rows=4)
    assert out.columns == ["doc_id", "source", "slot", "block", "slot_", "position"]
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == list(range(sum(sizes.values())))
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    n = Counter(stream(r.source) for r in rows)
    blocks = {s: math.ceil(n[s] / 4) for s in [*WEIGHTS, "*"]}
    want = simulated(blocks, {**WEIGHTS, "*": 1})
    got = {r.slot_: (stream(r.source), r.block) for r in rows}
    assert [got[i] for i in range(len(got))] == want
    by_position = sorted(rows, key=lambda r: r.position)
    assert [r.slot_ for r in by_position] == sorted(r.slot_ for r in rows)


def test_less_than_one_block_from_target(spark):
    rows = mix(frame(spark, {"a": 500, "b": 300, "c": 200, "z": 100}), WEIGHTS, block_rows=4).collect()
    order = sorted({(r.slot_, stream(r.source)) for r in rows})
    quota, seen = {**WEIGHTS, "*": 1}, Counter()
    for t, (_, s) in enumerate(order, 1):
        seen[s] += 1
        for x in quota:
            assert abs(seen[x] - Fraction(quota[x] * t, sum(quota.values()))) < 1


def test_repeated_keys_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a")] * 3 + [(1, "a")] * 3 + [(1, None)], "doc_id long, source string")
    assert sorted(r.position for r in mix(df, WEIGHTS).collect()) == list(range(7))
    assert mix(df.limit(0), WEIGHTS).collect() == []
    assert sorted(r.position for r in mix(df, {}).collect()) == list(range(7))


def test_no_python_in_the_plan(spark):
    plan = mix(frame(spark, {"a": 5}), WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_weights_are_bounded(spark):
    df = frame(spark, {"a": 5})
    for wrong in {"a": 4096}, {f"s{i}": 1 for i in range(600)}:
        with pytest.raises(ValueError, match="coarser"):
            mix(df, wrong)


def test_many_sources_give_every_position_once(spark):
    sizes = {f"s{i}": 1 + i % 5 for i in range(70)}
    weights = {s: 1 + i % 2 for i, s in enumerate(sizes)}
    rows = mix(frame(spark, sizes), weights, block_rows=2).collect()
    assert sorted(r.position for r in rows) == list(range(sum(sizes.values())))

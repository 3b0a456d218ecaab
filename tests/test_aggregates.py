"""Aggregates that follow the changes of their source, against plain loops."""

import random
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.plans import aggregates
from tidemark.plans.aggregates import AggregateTable, Measure

SCHEMA = "g string, h int, n int, d decimal(10,2), x double"

MEASURES = {
    "rows": Measure("count"),
    "n_n": Measure("count", "n"),
    "total": Measure("sum", "d"),
    "mean": Measure("avg", "n"),
    "low": Measure("min", "n"),
    "high": Measure("max", "d"),
    "kinds": Measure("count_distinct", "n"),
    "floats": Measure("sum", "x"),
}


def expected(source):
    groups = {}
    for g, h, n, d, x in source:
        groups.setdefault((g, h), []).append((n, d, x))
    out = []
    for key, held in groups.items():
        n, d, x = ([v for v in column if v is not None] for column in zip(*held))
        out.append(
            (*key, len(held), len(n), sum(d) if d else None, sum(n) / len(n) if n else None, min(n) if n else None,
             max(d) if d else None, len(set(n)), sum(x) if x else None)
        )
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def row(rng):
    pick = lambda values: rng.choice([None, *values])
    return (pick("abc"), pick([1, 2]), pick(range(9)), pick([Decimal("0.10"), Decimal("7.25"), Decimal("-3.00")]), pick([0.5, 2.0, -8.25]))


def test_late_rows_updates_and_deletions(spark, name):
    rng = random.Random(4)
    source = [row(rng) for _ in range(150)]
    now = {}
    kept = AggregateTable(name, lambda s: s.createDataFrame(now["source"], SCHEMA), ["g", "h"], MEASURES, buckets=3)

    def follow(gone, new, **settings):
        ops = [(*r, "D") for r in gone] + [(*r, rng.choice(["I", None])) for r in new]
        rng.shuffle(ops)
        return kept.apply(spark.createDataFrame(ops, SCHEMA + ", op string"), "op", ["D"], **settings)

    now["source"] = source
    assert follow([], source[:3]) == "create"
    assert rows(kept.read(spark)) == expected(source)
    for share in 0.1, 0.6, 0.9:
        gone = [r for r in source if rng.random() < share]
        left = list(source)
        for r in gone:
            left.remove(r)
        new = [row(rng) for _ in range(20)]
        source = now["source"] = left + new
        assert follow(gone, new, run_id=str(share)) == "apply"
        assert rows(kept.read(spark)) == expected(source)
        assert follow(gone, new, run_id=str(share)) == "skip"
    assert follow([], []) == "apply"
    assert rows(kept.read(spark)) == expected(source)
    # Rows that the table has never counted: an error, and nothing has changed.
    with pytest.raises(Exception, match="not counted"):
        follow([("nowhere", 1, 1, None, None)], [row(rng)])
    assert rows(kept.read(spark)) == expected(source)
    gone, now["source"] = source, []
    follow(gone, [])
    assert rows(kept.read(spark)) == []


def test_only_touched_groups_are_computed_again(spark, name, monkeypatch):
    source = [("a", 1, n, None, None) for n in range(5)] + [("b", 1, n, None, None) for n in range(5)]
    again = []
    plain = AggregateTable._recomputed
    monkeypatch.setattr(AggregateTable, "_recomputed", lambda self, wanted: again.append(rows(wanted)) or plain(self, wanted))
    left = [r for r in source if r[2] not in (0, 3)]
    kept = AggregateTable(name, lambda s: s.createDataFrame(left, SCHEMA), ["g", "h"], {"low": Measure("min", "n"), "size": Measure("count")})
    AggregateTable(name, lambda s: s.createDataFrame(source, SCHEMA), kept.by, kept.measures).create(spark)
    # 3 is in no group the least: the states suffice.  Of b the least goes too.
    ops = [("a", 1, 3, None, None, "delete"), ("b", 1, 3, None, None, "delete"), ("b", 1, 0, None, None, "delete")]
    left += [("a", 1, 0, None, None)]
    kept.apply(spark.createDataFrame(ops, SCHEMA + ", op string"), "op")
    assert again == [[("b", 1)]]
    assert rows(kept.read(spark)) == [("a", 1, 0, 4), ("b", 1, 1, 3)]


def test_interrupted_changes_count_once(spark, name, monkeypatch):
    source = [("a", 1, 1, None, None)] * 3
    kept = AggregateTable(name, lambda s: s.createDataFrame(source, SCHEMA), ["g"], {"total": Measure("sum", "n")})
    kept.create(spark)
    changes = spark.createDataFrame([("a", 1, 5, None, None), ("b", 1, 5, None, None)], SCHEMA).withColumn("op", F.lit("insert"))
    write = aggregates.write_partitions
    monkeypatch.setattr(aggregates, "write_partitions", lambda *a, **k: (write(*a, **k), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        kept.apply(changes, "op", run_id="one")
    monkeypatch.setattr(aggregates, "write_partitions", write)
    assert kept.apply(changes, "op", run_id="one") == "skip"
    assert rows(kept.read(spark)) == [("a", 8), ("b", 5)]


def test_settings_are_checked():
    for wrong in (dict(by=[]), dict(by="g"), dict(measures={}), dict(by=["g"], measures={"G": Measure("count")})):
        with pytest.raises(ValueError):
            AggregateTable(**{"name": "t", "source": None, "by": ["g"], "measures": {"n": Measure("count")}, **wrong})
    for wrong in (("median", "n"), ("sum", None)):
        with pytest.raises(ValueError):
            Measure(*wrong)

"""Deletions in change streams: every cut of the stream gives the history that a plain loop gives."""

import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.history import Snapshot, check_strategy, timestamp_strategy
from tidemark.plans.snapshot import append_changes, read_history
from tidemark.streaming import streams

SCHEMA = "k int, v string, w int, at timestamp_ntz, op string"
OUT = ["k", "v", "w", "valid_from", "valid_to"]


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def lives(changes, mode, checked=None):
    """The versions of a list of changes, one after another."""
    out, last = [], {}
    for k, v, w, at, op in sorted(changes, key=lambda c: c[3]):
        if k is None:
            if op != "D":
                out.append([k, v, w, at, None, "False"])
            continue
        prev = last.get(k)
        alive = prev is not None and prev[5] == "False" and prev[4] is None
        if op == "D":
            if mode == "ignore" or not alive:
                continue
            prev[4] = at
            if mode == "new_record":
                last[k] = [k, prev[1], prev[2], at, None, "True"]
                out.append(last[k])
            continue
        if alive and checked and prev[1] == v:
            continue
        if prev is not None and prev[4] is None:
            prev[4] = at
        last[k] = [k, v, w, at, None, "False"]
        out.append(last[k])
    return sorted((tuple(r) for r in out), key=str)


def kept(spark, name, mode):
    columns = [*OUT, "is_deleted"] if mode == "new_record" else OUT
    found = [tuple(r) for r in read_history(spark, name).select(*columns).collect()]
    return sorted((r if mode == "new_record" else (*r, "False") for r in found), key=str)


def take(spark, name, changes, cfg):
    df = spark.createDataFrame(changes, SCHEMA)
    append_changes(df.withColumn("gone", F.col("op") == "D").drop("op"), name, cfg, day(400), deleted="gone")


@pytest.mark.parametrize("mode", ["invalidate", "new_record", "ignore"])
@pytest.mark.parametrize("checked", [None, ["v"]])
def test_cuts_do_not_show(spark, name, mode, checked):
    rng = random.Random(f"{mode}{checked}")
    changes = [
        (rng.choice([1, 2, 3, 4, None]), rng.choice("ab"), i, day(i), rng.choice(["D", "I", "I"])) for i in range(60)
    ]
    strategy = check_strategy(checked, "at") if checked else timestamp_strategy("at")
    cfg = Snapshot("k", strategy, hard_deletes=mode)
    want = lives(changes, mode, checked)
    for cuts in ([60], [1, 13, 29, 60]):
        table = f"{name}_{len(cuts)}"
        for start, end in zip([0, *cuts], cuts):
            piece = changes[start:end]
            rng.shuffle(piece)
            take(spark, table, piece, cfg)
        assert kept(spark, table, mode) == want
        ids = read_history(spark, table).filter("k IS NOT NULL").select("scd_id")
        assert ids.distinct().count() == ids.count()


def test_odd_deletions_change_nothing(spark, name):
    cfg = Snapshot("k", timestamp_strategy("at"), hard_deletes="new_record")
    take(spark, name, [(1, "a", 0, day(1), "I"), (9, None, None, day(1), "D"), (None, None, None, day(1), "D")], cfg)
    once = kept(spark, name, "new_record")
    assert once == [(1, "a", 0, day(1), None, "False")]
    # Without a time, older than the version, as old as it, an empty set of changes.
    for odd in [(1, None, None, None, "D")], [(1, None, None, day(0), "D")], [(1, None, None, day(1), "D")], []:
        take(spark, name, odd, cfg)
        assert kept(spark, name, "new_record") == once
    # A null operation is no deletion; a second deletion says nothing new; the deleted version keeps the last values.
    take(spark, name, [(1, "b", 5, day(2), None)], cfg)
    take(spark, name, [(1, None, None, day(3), "D")], cfg)
    take(spark, name, [(1, None, None, day(4), "D"), (1, "c", 7, day(5), "I")], cfg)
    assert kept(spark, name, "new_record") == [
        (1, "a", 0, day(1), day(2), "False"),
        (1, "b", 5, day(2), day(3), "False"),
        (1, "b", 5, day(3), day(5), "True"),
        (1, "c", 7, day(5), None, "False"),
    ]


def test_stream(spark, tmp_path, name):
    source, cfg = str(tmp_path / "in"), Snapshot("k", timestamp_strategy("at"), hard_deletes="invalidate")
    deliveries = [
        [(1, "a", 0, day(1), "c"), (2, "b", 0, day(1), "c")],
        [(1, "b", 1, day(2), "u"), (2, None, None, day(3), "d")],
        [(1, None, None, day(4), "x"), (2, "b", 9, day(6), "c")],
    ]
    for delivery in deliveries:
        spark.createDataFrame(delivery, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source)
        streams.history_stream(
            stream, name, cfg, [F.desc("at")], str(tmp_path / "cp"), operation="op", deletes=("d", "x")
        ).awaitTermination()
    history = read_history(spark, name)
    assert "op" not in history.columns and "_deleted" not in history.columns
    assert rows(history, *OUT) == [
        (1, "a", 0, day(1), day(2)),
        (1, "b", 1, day(2), day(4)),
        (2, "b", 0, day(1), day(3)),
        (2, "b", 9, day(6), None),
    ]

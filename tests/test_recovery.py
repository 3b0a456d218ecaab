"""Loads, snapshots and streams that are stopped after each of their steps and run again."""

import datetime as dt
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.history import Snapshot, check_strategy, timestamp_strategy
from tidemark.plans import partitions
from tidemark.plans.load import Load, load, load_microbatches
from tidemark.plans.partitions import Publication
from tidemark.plans.publish import properties_of, table_location
from tidemark.plans.recovery import recover
from tidemark.plans.snapshot import read_history, take_snapshot
from tidemark.streaming import streams

T = dt.datetime


class Killed(BaseException):
    """The driver dies: nothing that handles errors runs."""


def killing(monkeypatch, step, when):
    """Stop the next publication before, within or after a step; gives the place back at the second one."""
    real = getattr(Publication, step)
    state = {"left": 1}

    def stopped(self, *args, **kwargs):
        if not state["left"]:
            return real(self, *args, **kwargs)
        state["left"] = 0
        partitions.LIVE.clear()  # a new driver knows of none
        if when == "before":
            raise Killed
        if when == "within":
            if step == "repoint":
                real(self, args[0][: len(args[0]) // 2])
            elif step == "finish":
                moves = self._moves()
                self._drop([m.values for m in moves if m.new is None])
                self.files.delete(next(m.old for m in moves if m.old))
            raise Killed
        real(self, *args, **kwargs)
        raise Killed

    monkeypatch.setattr(Publication, step, stopped)


STOPS = [
    ("begin", "before"), ("write", "before"), ("write", "after"), ("record", "after"), ("repoint", "within"),
    ("repoint", "after"), ("commit", "after"), ("finish", "within"), ("finish", "after"),
]

#: Nothing published, half of it, all but the clean-up, half of the clean-up.
KINDS = [("write", "after"), ("repoint", "within"), ("commit", "after"), ("finish", "within")]


def folders(spark, name):
    """What the table's location holds besides its partitions."""
    place = table_location(spark, name).removeprefix("file:")
    journal = f"{place}/{partitions.PUBLISHED}/journal"
    return os.listdir(journal) if os.path.isdir(journal) else []


def twice(work):
    with pytest.raises(Killed):
        work()
    work()


@pytest.mark.parametrize("step, when", STOPS)
def test_merge(spark, name, monkeypatch, step, when):
    """Keys that change their partition, a partition that is emptied, one that is new, and sums."""
    cfg = Load(unique_key="id", partition_by=["p"], rules={"n": "sum"})
    load(spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c"), (4, 40, None)], "id int, n int, p string"), name, cfg)
    batch = spark.createDataFrame([(1, 5, "b"), (3, 5, "d/e=f %"), (9, 9, "a"), (4, 1, None)], "id int, n int, p string")
    killing(monkeypatch, step, when)
    twice(lambda: load(batch, name, cfg, run_id="monday"))
    want = [(1, 15, "b"), (2, 20, "b"), (3, 35, "d/e=f %"), (4, 1, None), (4, 40, None), (9, 9, "a")]
    got = rows(spark.table(name))
    # A null key never matches its own, and id 4 is matched: its partition value is replaced by the batch's.
    want = [w for w in want if w != (4, 1, None) and w != (4, 40, None)] + [(4, 41, None)]
    assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    assert folders(spark, name) == []
    load(batch, name, cfg, run_id="monday")
    assert rows(spark.table(name)) == got  # the same load is not taken again
    load(batch, name, cfg, run_id="tuesday")
    assert rows(spark.table(name).filter("id = 1"), "n") == [(20,)]


@pytest.mark.parametrize("step, when", KINDS)
def test_overwrite_and_delete_insert(spark, name, monkeypatch, step, when):
    first = spark.createDataFrame([(i, i % 3, None if i == 7 else i % 2) for i in range(12)], "id int, p int, q int")
    by = dict(partition_by=["p", "q"])
    load(first, name, Load(strategy="append", **by))
    killing(monkeypatch, step, when)
    batch = spark.createDataFrame([(100, 1, None), (101, 0, 0), (102, 5, 5)], "id int, p int, q int")
    twice(lambda: load(batch, name, Load(strategy="insert_overwrite", **by), run_id="once"))
    # Rows without a partition value are added to, the others replaced.
    want = [r for r in rows(first) if (r[1], r[2]) != (0, 0)] + rows(batch)
    assert rows(spark.table(name)) == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    replaced = batch.withColumn("p", F.lit(2))
    load(replaced, name, Load(strategy="delete+insert", unique_key="id", **by))
    kept = [r for r in want if r[0] < 100]
    assert rows(spark.table(name)) == sorted(kept + rows(replaced), key=lambda r: [(v is None, str(v)) for v in r])
    assert folders(spark, name) == []


@pytest.mark.parametrize("step, when", KINDS)
def test_snapshot(spark, name, monkeypatch, step, when):
    def people(*found):
        return spark.createDataFrame(list(found), "id int, v string, at timestamp_ntz")

    cfg = Snapshot("id", timestamp_strategy("at"), hard_deletes="invalidate")
    looks = [
        people((1, "a", T(2024, 1, 1)), (2, "x", T(2024, 1, 1))),
        people((1, "b", T(2024, 1, 2)), (3, "z", T(2024, 1, 2))),
        people((1, "c", T(2024, 1, 3))),
    ]
    other = f"{name}_whole"
    for i, look in enumerate(looks):
        take_snapshot(look, other, cfg, T(2024, 2, i + 1))
    take_snapshot(looks[0], name, cfg, T(2024, 2, 1))
    killing(monkeypatch, step, when)
    twice(lambda: take_snapshot(looks[1], name, cfg, T(2024, 2, 2)))
    take_snapshot(looks[2], name, cfg, T(2024, 2, 3))
    assert rows(read_history(spark, name)) == rows(read_history(spark, other))
    assert folders(spark, name) == []


@pytest.mark.parametrize("step, when", KINDS)
def test_streams(spark, name, tmp_path, monkeypatch, step, when):
    """The stream dies in its second micro-batch; started again it goes on where it was, sums included."""
    path, schema = str(tmp_path / "in"), "k int, at int, n int, v string, b int"
    for found in ([(1, 1, 5, "a", 0), (2, 1, 5, "a", 1)], [(1, 2, 3, "b", 1), (3, 1, 1, "a", 2)], [(1, 3, 4, "c", 1)]):
        spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(path)
    cfg = Load(unique_key="k", partition_by=["b"], rules={"n": "sum"})
    versions = Snapshot("k", check_strategy(["v"]))
    handled = []
    monkeypatch.setattr(streams, "_start", lambda stream, table, handle, *rest: handled.append(handle))
    files = streams.file_stream(spark, path, 1)
    streams.upsert_stream(files, name, cfg, ["at"], str(tmp_path / "cp"))
    streams.history_stream(files, f"{name}_h", versions, [F.desc("at")], str(tmp_path / "cph"), clock_of=lambda i: T(2024, 1, i + 1))
    batches = [
        spark.createDataFrame(found, schema)
        for found in ([(1, 1, 5, "a", 0), (2, 1, 5, "a", 1)], [(1, 2, 3, "b", 1), (3, 1, 1, "a", 2)], [(1, 3, 4, "c", 1)])
    ]
    for handle in handled:
        handle(batches[0], 0)
        with pytest.MonkeyPatch.context() as patch:
            killing(patch, step, when)
            twice(lambda handle=handle: handle(batches[1], 1))
        handle(batches[2], 2)
        handle(batches[2], 2)  # delivered again
    assert rows(spark.table(name), "k", "n", "b") == [(1, 12, 1), (2, 5, 1), (3, 1, 2)]
    history = rows(read_history(spark, f"{name}_h"), "k", "v", "valid_from", "valid_to")
    assert [r for r in history if r[0] == 1] == [
        (1, "a", T(2024, 1, 1), T(2024, 1, 2)), (1, "b", T(2024, 1, 2), T(2024, 1, 3)), (1, "c", T(2024, 1, 3), None),
    ]
    assert len(history) == 5 and folders(spark, name) == folders(spark, f"{name}_h") == []


def test_windows(spark, name, monkeypatch):
    events = spark.createDataFrame([(i, T(2024, 1, 1 + i % 4)) for i in range(20)], "id int, at timestamp_ntz")
    events = events.withColumn("day", F.col("at").cast("date"))
    cfg = Load(event_time="at", batch_size="day", partition_by=["day"])
    load(events, name, Load(partition_by=["day"]))
    late = events.filter("id % 4 <> 1").withColumn("id", F.col("id") + 100)
    killing(monkeypatch, "repoint", "within")
    twice(lambda: load_microbatches(late, name, cfg, T(2024, 1, 1), T(2024, 1, 4), windows_per_job=3))
    want = sorted([i + 100 for i in range(20) if i % 4 in (0, 2)] + [i for i in range(20) if i % 4 == 3])
    assert [r[0] for r in sorted(rows(spark.table(name), "id"))] == want


def test_an_error_is_undoneat_once(spark, name, monkeypatch):
    cfg = Load(unique_key="id", partition_by=["p"])
    df = spark.createDataFrame([(1, 1), (2, 2)], "id int, p int")
    load(df, name, cfg)

    def fail(self, marks):
        raise OSError("the store is away")

    monkeypatch.setattr(Publication, "commit", fail)
    with pytest.raises(OSError):
        load(df.withColumn("p", F.lit(7)), name, cfg)
    assert rows(spark.table(name)) == [(1, 1), (2, 2)] and folders(spark, name) == []
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2


def test_another_live_load_is_left_alone(spark, name, monkeypatch):
    """A load that begins while another one is under way doesn't undo it."""
    cfg = Load(strategy="insert_overwrite", partition_by=["p"])
    load(spark.createDataFrame([(1, 1), (2, 2)], "id int, p int"), name, cfg)
    real, inner = Publication.commit, []

    def commit(self, marks):
        if not inner:
            inner.append(1)
            load(spark.createDataFrame([(20, 2)], "id int, p int"), name, cfg)
        real(self, marks)

    monkeypatch.setattr(Publication, "commit", commit)
    load(spark.createDataFrame([(10, 1)], "id int, p int"), name, cfg)
    assert rows(spark.table(name)) == [(10, 1), (20, 2)]


def test_replaced_folders_go_and_appends_stay(spark, name):
    cfg = Load(unique_key="id", partition_by=["p"])
    df = spark.createDataFrame([(1, 1), (2, 2)], "id int, p int")
    for _ in range(3):
        load(df, name, cfg)
    load(df.withColumn("id", F.col("id") + 10), name, Load(strategy="append", partition_by=["p"]))
    load(df.filter("p = 1"), name, cfg)
    assert rows(spark.table(name)) == [(1, 1), (11, 1), (12, 2), (2, 2)]
    place = table_location(spark, name).removeprefix("file:")
    found = [os.path.join(d, f) for d, _, fs in os.walk(place) for f in fs if f.endswith(".parquet")]
    assert len(found) == len({f for r in spark.table(name).select("_metadata.file_path").distinct().collect() for f in r})
    assert len(os.listdir(f"{place}/{partitions.PUBLISHED}")) == 3  # the journal and two versions


def test_recovery_without_a_journal_is_nothing(spark, name):
    load(spark.range(3), name, Load())
    recover(spark, name)
    load(spark.createDataFrame([(1, 1)], "id int, p int"), f"{name}_p", Load(partition_by=["p"]))
    recover(spark, f"{name}_p")
    assert spark.table(name).count() == 3 and "tidemark.run" not in properties_of(spark, name)

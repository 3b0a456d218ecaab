"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors become integers, floor(64 x) for each component.  The index holds them in blocks; within a block every component has
its vectors in the order of their values, cut into segments of a few neighbouring values.  What a segment adds to a query's
score, its impact, is the same for all its vectors but for the width of the segment.  Impacts are counted from the least that
the component can add, so they are never negative, and are quantised into classes.

A block is searched from the highest class of impacts to the lowest.  After some classes a vector's score is at least what its
segments gave at least; and at most what they gave at most plus, for each component not yet met, the largest impact that is
left there.  Vectors whose upper bound is below the kth best lower bound are proven out.  A query is done with a block when
few enough are left, and those that may be members are scored anew from their whole vectors, exactly; otherwise the next
classes are processed, down to the last, so that no vector is lost to a limit.  Segments are processed for many queries at
once, as a product of what each query gives for a segment (nothing, if it isn't its turn) with the segments' vectors.  A task
keeps the best ``k`` of each query over its blocks, so that later blocks meet a higher kth score.

Queries are answered in sets of about ``QUERIES``, each against the whole index: what is sent to the tasks has a bound that
does not grow with the data.  Only the best of each task are shuffled, at most ``k`` rows for each query.

Defined results: a vector that is null, or has a null or non-finite component, or one beyond 2**21 (whose products could leave
64 bits), takes no part.  A shorter vector counts as zero in the components it lacks.  A row is known by its vec_id: rows with
the query's own id are no candidates.  A query row that repeats another in id and vector is answered once; one that shares only
the id is a query of its own.  A null id is no query; as a candidate it comes after equal scores.  Empty tables give no rows,
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stage

#: Vectors of a block of the index; their places take 16 bits.
BLOCK = 8_192

#: Queries that are sent to the tasks at once, about.
QUERIES = 16_384

#: Components are multiplied by this and rounded down.
SCALE = 64

#: Segments of a component in a block, at most.
SEGMENTS = 24

#: Classes of impacts, and the lowest class that each turn processes.
CLASSES, TURNS = 8, (2, 0)

#: A query is done with a block when at most this share of it, or this many times k, may still be members.
SHARE, TIMES = 1 / 64, 4

#: Queries whose segments are processed at once.
TOGETHER = 256

#: Components beyond this take no part.
LIMIT = 2.0**21


def integers(vector: Column) -> Column:
    """The vector's components in integers, or null if it takes no part."""
    wide = vector.cast("array<double>")
    sound = F.forall(wide, lambda x: x.isNotNull() & (F.abs(x) <= LIMIT) & ~F.isnan(x))
    return F.when(sound, F.transform(wide, lambda x: F.floor(x * SCALE).cast("int")))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """For each row of ``queries`` (vec_id, embedding) the ``k`` rows of ``vectors`` with the highest inner products.

    Returns query_id, rank, vec_id, score; equal scores by ascending vec_id.
    """
    spark = vectors.sparkSession
    named = [F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("v")]
    asked = queries.select(*named).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).distinct()
    asked = stage(asked, "queries").frame
    rows = stage(vectors.select(*named).where(F.col("v").isNotNull()), "vectors").frame
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    total = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not shape.n or not total.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(shape.width, total.width, 1)
    blocks = shape.n // (BLOCK - BLOCK // 16) + 1  # rows are dealt out almost evenly
    index = stage(build(rows, blocks, width), "index").frame

    sets = -(-total.n // QUERIES)
    member = F.pmod(F.xxhash64("vec_id", "v"), F.lit(sets))
    answers = None
    for i in range(sets):
        found = _search_set(spark, index, asked.where(member == i), i << 32, blocks, width, k)
        answers = found if answers is None else answers.unionByName(found)
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# -- the index --------------------------------------------------------------------------------------------------


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of integers as the rows of a matrix, with zeros where they are shorter."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(flat) == len(sizes) * width:
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
    return out


def build(rows: DataFrame, blocks: int, width: int) -> DataFrame:
    """Blocks of the index: a number, the vectors' ids and whole vectors, and for each component their order by value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ids = table.column("vec_id").combine_chunks()
            matrix = _matrix(table.column("v").combine_chunks(), width).astype(np.int32)
            order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int16)  # one line for each component
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            packed = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (matrix, order)]
            number = pa.array([TaskContext.get().partitionId()], pa.int32())
            return pa.RecordBatch.from_arrays([number, lists, *packed], names=["block", "ids", "vectors", "orders"])

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, BLOCK - count)
                held.append(part)
                start, count = start + part.num_rows, count + part.num_rows
                if count == BLOCK:
                    yield block()
                    held, count = [], 0
        if held:
            yield block()

    return rows.repartition(blocks).mapInArrow(run, "block int, ids array<long>, vectors binary, orders binary")


class Block:
    """A block of the index, in arrays: the segments of all components, one after another."""

    def __init__(self, ids: pa.Array, vectors: bytes, orders: bytes, width: int):
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.vectors = np.frombuffer(vectors, np.int32).reshape(-1, width).astype(np.int64)
        orders = np.frombuffer(orders, np.int16).reshape(width, -1).astype(np.int64)
        values = np.take_along_axis(self.vectors.T, orders, axis=1)
        self.low, self.high = values[:, 0], values[:, -1]
        step = -(-(self.high - self.low + 1) // SEGMENTS)
        first, least, most, component = [], [], [], []
        for i in range(width):
            starts = np.flatnonzero(np.diff((values[i] - self.low[i]) // step[i], prepend=-1))
            first.append(starts)
            least.append(values[i, starts])
            most.append(values[i, np.append(starts[1:], len(self.ids)) - 1])
            component.append(np.full(len(starts), i))
        self.least, self.most, self.component = (np.concatenate(x) for x in (least, most, component))
        # The vectors of each segment, as a line of ones.
        self.held = np.zeros((len(self.component), len(self.ids)), np.float32)
        line = 0
        for i in range(width):
            for a, b in zip(first[i], np.append(first[i][1:], len(self.ids)), strict=True):
                self.held[line, orders[i, a:b]] = 1
                line += 1

    def product(self, gains: np.ndarray, whole: float) -> np.ndarray:
        """What the vectors get from their segments; exact, as sums below ``whole`` are whole numbers in that many bits."""
        if whole < 2**24:
            return gains.astype(np.float32) @ self.held
        if whole < 2**53:
            return gains.astype(np.float64) @ self.held.astype(np.float64)
        return gains @ self.held.astype(np.int64)


# -- score at a time --------------------------------------------------------------------------------------------


def members(block: Block, queries: np.ndarray, k: np.ndarray, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each query (its number) the positions of vectors that may be among its best ``k``; all others are proven not to be.

    ``floor``: a score that ``k`` vectors seen before have at least; the smallest number, if there are none.
    """
    size, parts = len(block.ids), block.component
    few = np.maximum(TIMES * k, int(size * SHARE))
    reach = np.abs(queries) * (block.high - block.low)
    base = np.minimum(queries * block.low, queries * block.high).sum(axis=1)
    # The least and the most that a segment adds, above the least of its component.
    q = queries[:, parts]
    ends = np.sort([q * block.least, q * block.most], axis=0) - np.minimum(q * block.low[parts], q * block.high[parts])
    lower, upper = ends[0], ends[1]
    whole = float(reach.sum(axis=1, dtype=np.float64).max(initial=0)) * 2 + 1
    largest = np.maximum(reach.max(axis=1, initial=0), 1)
    impact = upper * CLASSES // (largest[:, None] + 1)
    # In a component the impacts rise or fall, so what is left of it is a prefix or a suffix.
    starts = np.flatnonzero(np.diff(parts, prepend=-1))
    open_ = np.arange(len(queries))
    for turn in TURNS:
        done = impact[open_] >= turn
        left = np.maximum.reduceat(np.where(done, 0, upper[open_]), starts, axis=1)  # the largest that is left
        at_least = block.product(np.where(done, lower[open_], 0), whole)
        above = block.product(np.where(done, upper[open_] - left[:, parts], 0), whole)
        at_most = above + left.sum(axis=1)[:, None].astype(above.dtype)
        again = []
        for row, i in enumerate(open_):
            bound = floor[i] - base[i]
            if size >= k[i]:
                bound = max(bound, int(np.partition(at_least[row], size - k[i])[size - k[i]]))
            possible = np.flatnonzero(at_most[row] >= bound)
            if turn == TURNS[-1] or len(possible) <= few[i]:
                yield i, possible
            else:
                again.append(i)
        open_ = np.array(again, np.int64)
        if not len(open_):
            return


class Best:
    """The best ``k`` of a query so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else -(2**62)

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = (np.append(a, b) for a, b in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


def _search_set(spark: SparkSession, index: DataFrame, asked: DataFrame, first: int, blocks: int, width: int, k: int) -> DataFrame:
    """The best of each task: query (a number, from ``first``), query_id, vec_id, score."""
    rows = asked.orderBy("vec_id", "v").collect()  # about QUERIES rows
    matrix = np.zeros((len(rows), width), np.int64)
    for line, row in zip(matrix, rows, strict=True):
        line[: len(row.v)] = row.v
    shared = spark.sparkContext.broadcast((np.array([r.vec_id for r in rows], np.int64), matrix.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = shared.value
        tops = [Best(k) for _ in own]
        for batch in batches:
            for _, ids, vectors, orders in zip(*batch.columns, strict=True):
                block = Block(ids.values, vectors.as_py(), orders.as_py(), width)
                for start in range(0, len(own), TOGETHER):
                    part = slice(start, start + TOGETHER)
                    # The query's own rows take places, so as many more are asked for.
                    mine = [np.flatnonzero(block.known & (block.ids == me)) for me in own[part]]
                    wanted = np.array([k + len(m) for m in mine])
                    asked = queries[part].astype(np.int64)
                    floor = np.array([t.floor for t in tops[part]])
                    for i, at in members(block, asked, wanted, floor):
                        at = np.setdiff1d(at, mine[i])
                        tops[start + i].add(block.vectors[at] @ asked[i], block.ids[at], block.known[at])
        for i, (top, me) in enumerate(zip(tops, own, strict=True)):
            if len(top.ids):
                same = [pa.array(np.full(len(top.ids), x, np.int64)) for x in (first + i, me)]
                columns = [*same, pa.array(top.ids, mask=~top.known), pa.array(top.scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "query_id", "vec_id", "score"])

    # A block to a task: a block is work for all queries of the set, and a task's batches hold a block or a few.
    return index.repartitionByRange(blocks, "block").mapInArrow(run, "query long, query_id long, vec_id long, score long")

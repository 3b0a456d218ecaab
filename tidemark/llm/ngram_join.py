"""Exact Jaccard self-join of documents on their word n-grams, as a blocked sparse matrix product.

The incidence matrix has a row for each distinct n-gram set (documents with equal sets share one: a *node*) and a column
for each n-gram.  Its product with its own transpose counts overlaps.  Only a part of it is worked out:

1. *Order.*  All tasks count n-grams into a sketch of fixed size.  Columns are ordered by that count, then by hash; the
   order only has to be the same everywhere, so the sketch's collisions cost time and never a link.
2. *Prefixes.*  Two sets that link share a column among the first n - ceil(t * n) + 1 of either (its *prefix*).
3. *Product.*  Prefix columns that at least two nodes hold are multiplied column by column.  Pairs of nodes accumulate
   their shared columns; pairs whose sizes differ too much, or whose count and remaining columns can't reach the
   overlap that both sizes ask for, are discarded.  *Hot columns*, held by more than HOT nodes, are not multiplied; they only
   connect their nodes.
4. *Blocks.*  Nodes that pairs or hot columns connect form clusters.  The whole rows of a cluster are multiplied in one
   tile of bounded weight.  In larger clusters, pairs are verified one by one, and nodes of hot columns are compared with their
   cluster's leader; those that don't link with it form tiles with one another and with the rest.  A tile accumulates
   overlaps over blocks of columns and returns a spanning forest of its links, never its pairs.
5. *Components* of all links.

Sets are of 64-bit hashes of n-grams.  Copies never multiply: only nodes take part.

Defined results: letters A-Z are lower-cased, words are runs of anything but ASCII white space; a text with fewer words than n
has its whole sequence as the only n-gram; a text without words, or null, has an empty set and is linked with nothing; rows with a
null id are linked like others, but do not name a component (one made of such rows only has a null id); repeated rows are
copies of each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import FILTER_BITS, chunks, concerned, free_name
from tidemark.llm.graph import components
from tidemark.session import stage

#: Cells of the sketch, and how many parts it travels in.
CELLS, PARTS = 1 << 20, 64
#: Nodes of a column from which on it is hot.
HOT = 128
#: Weight of a block of a tile: its n-grams, and so much for each node.
BLOCK_WEIGHT, NODE_WEIGHT = 4_000_000, 1_000
#: N-grams of a tile that are numbered at once, about; cells of a block of columns; rows whose links are looked at at once.
RANGE_WEIGHT, BLOCK_CELLS, BLOCK_ROWS = 500_000, 1 << 22, 256


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


#: Bytes of text that are hashed at once, unless a single word is longer.
STRETCH = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_VALUE = np.random.default_rng(20_240_607).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]  # letters A-Z are lower-cased


class Grams:
    """Distinct n-gram hashes of texts.

    A word's hash is a polynomial of its bytes' values: differences of running sums, moved back to the power 0, so
    all words of a text are hashed at once.
    """

    def __init__(self, n: int):
        self.n = n
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self.powers):
            size = max(size, 2 * len(self.powers))
            steps = [np.full(size, x, np.uint64) for x in (_ODD, pow(_ODD, -1, 1 << 64))]
            for step in steps:
                step[0] = 1
            self.powers, self.inverse = (np.multiply.accumulate(step) for step in steps)

    def words(self, raw: np.ndarray) -> np.ndarray:
        """Hashes of the words of some bytes, in order."""
        if len(raw) > STRETCH:
            # Cut at the first blank behind each stretch.
            blanks = np.flatnonzero(_BLANK[raw])
            at = np.searchsorted(blanks, np.arange(STRETCH, len(raw), STRETCH))
            cuts = [0, *np.unique(blanks[at[at < len(blanks)]]).tolist(), len(raw)]
            if len(cuts) > 2:
                return np.concatenate([self._hash(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])
        return self._hash(raw)

    def _hash(self, raw: np.ndarray) -> np.ndarray:
        self._grow(len(raw))
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~_BLANK[raw]
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        terms = _VALUE[raw] * self.powers[: len(raw)]
        sums = np.cumsum(terms)
        total = (sums[ends - 1] - sums[starts] + terms[starts]) * self.inverse[starts]
        return _mixed(total + (ends - starts).astype(np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        h = self.words(np.frombuffer((text or "").encode(), np.uint8))
        if not len(h):
            return np.zeros(0, np.int64)
        n = min(self.n, len(h))
        total = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            total = _mixed(total + h[i : len(h) - n + 1 + i])
        return np.unique(total.view(np.int64))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for part in chunks(batch, "text"):
            yield part, part.column("text").to_pylist()


def _sketch(docs: DataFrame, n: int) -> np.ndarray:
    """How often the n-grams of each cell occur over all documents."""
    width = CELLS // PARTS

    def count(batches):
        grams, cells = Grams(n), np.zeros(CELLS, np.int64)
        for _, texts in _texts(batches):
            found = np.concatenate([grams(t) for t in texts])
            cells += np.bincount(found & (CELLS - 1), minlength=CELLS)
        packed = [zlib.compress(cells[i * width : (i + 1) * width].tobytes(), 1) for i in range(PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(packed)], names=["part", "cells"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cells = np.frombuffer(zlib.decompress(packed), np.int64)
                sums[part] = sums[part] + cells if part in sums else cells
        packed = [zlib.compress(c.tobytes(), 1) for c in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], names=["part", "cells"])

    schema = "part int, cells binary"
    parts = docs.select("text").mapInArrow(count, schema).repartition(PARTS, "part").mapInArrow(add, schema).collect()
    total = np.zeros(CELLS, np.int64)
    for row in parts:
        total[row.part * width : (row.part + 1) * width] = np.frombuffer(zlib.decompress(row.cells), np.int64)
    return total


def _least_overlap(size: np.ndarray | int, percent: int):
    """ceil(percent / 100 * size): no partner of a set shares less with it."""
    return (percent * size + 99) // 100


def _prefixes(docs: DataFrame, n: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """(doc_id, t, node, n_shingles, prefix): the text's hash, and prefix columns in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # CELLS counts
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        grams, counts = Grams(n), shared.value
        for part, texts in _texts(batches):
            nodes, sizes, prefixes = [], [], []
            for text in texts:
                g = grams(text)
                order = np.lexsort((g, counts[g & (CELLS - 1)]))
                nodes.append(_signed(xxhash.xxh64_intdigest(g.tobytes())) if len(g) else None)
                sizes.append(len(g))
                prefixes.append(g[order[: len(g) - _least_overlap(len(g), percent) + 1]] if len(g) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("t"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "t", "node", "n_shingles", "prefix"],
            )

    schema = f"doc_id {id_type}, t bigint, node bigint, n_shingles bigint, prefix array<bigint>"
    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(run, schema)


def _place(node: int, doc_id) -> int:
    """The bit of a node's row in the filter."""
    return xxhash.xxh64_intdigest(f"{node} {doc_id}") % FILTER_BITS


def _sets(docs: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """(node, grams) of the ``wanted`` nodes (node, doc_id).

    Only the row with a node's smallest id gives its set; a filter of fixed size lets few other rows through.
    """

    def places(batches):
        for batch in batches:
            at = {_place(x, d) for x, d in zip(batch.column("node").to_pylist(), batch.column("doc_id").to_pylist())}
            yield pa.RecordBatch.from_arrays([pa.array(list(at), pa.int64())], names=["at"])

    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    bits = wanted.select("node", "doc_id").mapInArrow(places, "at bigint").groupBy(F.shiftright("at", 6).alias("i"))
    rows = bits.agg(F.bit_or(bit).alias("b")).collect()  # FILTER_BITS / 64 rows at most
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows:
        words[r.i] = r.b
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        grams, filter_ = Grams(n), shared.value
        for part, texts in _texts(batches):
            nodes, sets = [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                g = grams(text)
                if len(g):
                    node = _signed(xxhash.xxh64_intdigest(g.tobytes()))
                    at = _place(node, doc_id)
                    if (int(filter_[at >> 6]) >> (at & 63)) & 1:
                        nodes.append(node)
                        sets.append(g)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "grams"]
            )

    found = docs.mapInArrow(run, "node bigint, grams array<bigint>")
    return found.dropDuplicates(["node"]).join(wanted.select("node"), "node", "left_semi")


def _reaches(overlap: Column, x: Column, y: Column, percent: int) -> Column:
    """overlap / (x + y - overlap) >= percent / 100, in whole numbers."""
    return overlap * (100 + percent) >= (x + y) * percent


def _pairs(columns: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that share cold prefix columns and may reach the threshold."""
    hot = columns.groupBy("node").agg(F.sum(F.col("hot").cast("int")).alias("n_hot"))
    cold = columns.where(~F.col("hot"))
    x = cold.select("gram", F.col("node").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"))
    y = cold.select("gram", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"))
    near = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    shared = (
        x.join(y, (x.gram == y.gram) & (F.col("a") < F.col("b")) & near)
        .groupBy("a", "b", "na", "nb")
        .agg(F.count(F.lit(1)).alias("k"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    )
    # Shared columns up to the last one were all counted, but for hot ones.
    for side in ("a", "b"):
        shared = shared.join(hot.select(F.col("node").alias(side), F.col("n_hot").alias(f"h{side}")), side)
    most = F.col("k") + F.least("ha", "hb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return shared.where(_reaches(most, F.col("na"), F.col("nb"), percent)).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.size(F.array_intersect("ga", "gb"))
    return both.where(_reaches(overlap, F.size("ga"), F.size("gb"), percent)).select("a", "b")


def _tile(x: list[np.ndarray], y: list[np.ndarray] | None = None) -> np.ndarray:
    """Overlaps of all rows of two blocks, or of one with itself, accumulated over ranges and blocks of columns.

    Rows are sorted and hashes spread evenly, so a range of hashes is a slice of every row: only a range is numbered at once.
    """
    rows = x if y is None else [*x, *y]
    sizes = np.array([len(s) for s in rows])
    ranges = int(sizes.sum()) // RANGE_WEIGHT + 1
    step = (1 << 64) // ranges
    bounds = np.array([k * step - (1 << 63) for k in range(1, ranges)], np.int64)
    cuts = np.array([[0, *np.searchsorted(s, bounds), len(s)] for s in rows])
    total = np.zeros((len(x), len(x if y is None else y)), np.float32)
    for k in range(ranges):
        columns, at = np.unique(np.concatenate([s[c[k] : c[k + 1]] for s, c in zip(rows, cuts)]), return_inverse=True)
        row = np.repeat(np.arange(len(rows)), cuts[:, k + 1] - cuts[:, k])
        if y is None:
            shared = np.bincount(at, minlength=len(columns)) > 1
        else:
            first = row < len(x)
            shared = (np.bincount(at[first], minlength=len(columns)) > 0) & (np.bincount(at[~first], minlength=len(columns)) > 0)
        number = np.cumsum(shared) - 1
        keep = shared[at]
        at, row = number[at[keep]], row[keep]
        order = np.argsort(at, kind="stable")
        at, row = at[order], row[order]
        width, most = int(shared.sum()), BLOCK_CELLS // len(rows) + 1
        for start in range(0, width, most):
            s, e = np.searchsorted(at, [start, start + most])
            block = np.zeros((len(rows), min(most, width - start)), np.float32)
            block[row[s:e], at[s:e] - start] = 1
            total += block @ block.T if y is None else block[: len(x)] @ block[len(x) :].T
    if y is None:
        np.fill_diagonal(total, sizes)
    return total


def _row_blocks(n: int) -> Iterator[slice]:
    return (slice(start, start + BLOCK_ROWS) for start in range(0, n, BLOCK_ROWS))


def _forest(x: np.ndarray, y: np.ndarray, link: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links connect: each node with the smallest of its component in the tile."""
    nx, ny = x.copy(), y.copy()
    top = np.iinfo(np.int64).max
    while True:
        to_x, to_y = nx.copy(), ny.copy()
        for s in _row_blocks(len(x)):
            to_y = np.minimum(to_y, np.where(link[s], nx[s, None], top).min(0, initial=top))
        for s in _row_blocks(len(x)):
            to_x[s] = np.minimum(nx[s], np.where(link[s], to_y[None, :], top).min(1, initial=top))
        if (to_x == nx).all() and (to_y == ny).all():
            break
        nx, ny = to_x, to_y
    return [(int(a), int(b)) for a, b in zip([*x, *y], [*nx, *ny]) if a != b]


def _cluster_links(placed: DataFrame, percent: int) -> DataFrame:
    """(a, b): edges that connect what the links within each cluster connect.  ``placed``: (cluster, node, grams), a tile each."""

    def multiply(tile: pd.DataFrame) -> pd.DataFrame:
        nodes, grams = tile.node.to_numpy(), [np.asarray(g) for g in tile.grams]
        return _edges(nodes, grams, None, None, percent)

    return placed.select("cluster", "node", "grams").groupBy("cluster").applyInPandas(multiply, "a bigint, b bigint")


def _edges(x: np.ndarray, gx: list, y: np.ndarray | None, gy: list | None, percent: int) -> pd.DataFrame:
    """Spanning edges of the links between two blocks of nodes, or within one."""
    sizes = [np.array([len(g) for g in side]) for side in (gx, gx if gy is None else gy)]
    overlaps = _tile(gx, gy)
    enough = np.empty(overlaps.shape, bool)
    for s in _row_blocks(len(gx)):
        enough[s] = overlaps[s].astype(np.int64) * (100 + percent) >= (sizes[0][s, None] + sizes[1][None, :]) * percent
    del overlaps
    return pd.DataFrame(_forest(x, x if y is None else y, enough), columns=["a", "b"], dtype="int64")


def _large_cluster_links(members: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The same for clusters of any size.  ``members``: (node, cluster, hot, weight).

    Pairs that share cold columns are verified one by one.  Nodes of hot columns that link with their cluster's leader
    need no comparison among themselves; the others form tiles with one another and with those.
    """
    links = _linked(pairs, sets, percent)
    hot = members.where("hot")
    leaders = hot.groupBy("cluster").agg(F.min("node").alias("leader"))
    led = hot.join(leaders, "cluster")
    to_leader = led.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    main = stage(_linked(to_leader, sets, percent), "links").frame
    near = main.select(F.col("a").alias("node")).withColumn("near", F.lit(True))
    flagged = led.join(near, "node", "left").withColumn("near", F.coalesce("near", F.col("node") == F.col("leader")))
    blocks = flagged.groupBy("cluster").agg(
        *[
            F.ceil(F.sum(F.when(F.col("near") == is_near, F.col("weight"))) / BLOCK_WEIGHT).alias(name)
            for name, is_near in (("main", True), ("far", False))
        ]
    )
    known = flagged.join(blocks.where("far is not null"), "cluster").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.when(F.col("near"), F.col("main")).otherwise(F.col("far")))
    )

    def numbers(n: str) -> Column:
        return F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)

    def tile(i: Column, with_near: bool, j: Column) -> Column:
        return F.struct(i.alias("i"), F.lit(with_near).alias("with_near"), j.alias("j"))

    # A far block meets every near block, and every far block once.
    as_near = F.transform(numbers("far"), lambda i: tile(i, True, F.col("block")))
    as_far = F.concat(
        F.transform(numbers("far"), lambda i: tile(F.least(i, F.col("block")), False, F.greatest(i, F.col("block")))),
        F.transform(numbers("main"), lambda j: tile(F.col("block"), True, j)),
    )
    tiles = F.explode(F.when(F.col("near"), as_near).otherwise(as_far)).alias("t")
    placed = known.join(sets, "node").select("cluster", "node", "near", "block", "grams", tiles)
    placed = placed.select("cluster", "t.*", "node", "near", "block", "grams")

    def multiply(part: pd.DataFrame) -> pd.DataFrame:
        first = part.iloc[0]
        x = part[(~part.near) & (part.block == first.i)]
        y = part[part.near] if first.with_near else part[part.block == first.j]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        gx, gy = ([np.asarray(g) for g in side.grams] for side in (x, y))
        return _edges(x.node.to_numpy(), gx, y.node.to_numpy(), gy, percent)

    product = placed.groupBy("cluster", "i", "with_near", "j").applyInPandas(multiply, "a bigint, b bigint")
    return links.union(main).union(product)


def _links(docs: DataFrame, n: int, columns: DataFrame, ids: DataFrame, percent: int) -> DataFrame:
    """(a, b): edges that connect what all links connect."""
    pairs = stage(_pairs(columns, percent), "pairs").frame
    hot = columns.where("hot")
    leaders = hot.groupBy("gram").agg(F.min("node").alias("b"))
    stars = hot.join(leaders, "gram").select(F.col("node").alias("a"), "b").distinct()
    clusters = components(pairs.union(stars))
    about = columns.groupBy("node").agg(F.max("hot").alias("hot"), (F.max("n") + NODE_WEIGHT).alias("weight"))
    members = clusters.join(about, "node").join(ids, "node").withColumnRenamed("root", "cluster")
    total = members.groupBy("cluster").agg(F.sum("weight").alias("total"))
    members = stage(members.join(total, "cluster"), "members").frame
    placed = _sets(docs, n, members).join(members.select("node", "cluster", "total"), "node")
    large = members.where(F.col("total") > BLOCK_WEIGHT)
    if large.isEmpty():
        return _cluster_links(placed, percent)
    placed = stage(placed, "sets").frame
    sets = placed.where(F.col("total") > BLOCK_WEIGHT).select("node", "grams")
    inside = pairs.join(large.select(F.col("node").alias("a")), "a", "left_semi").select("a", "b")
    links = _cluster_links(placed.where(F.col("total") <= BLOCK_WEIGHT), percent)
    return links.union(_large_cluster_links(large, inside, sets, percent))


def _grouped(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, t, n_shingles, node, root, component_id): a row for each document; the last three are null without words."""
    if not 0 < percent <= 100:
        raise ValueError("percent is between 1 and 100")
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = stage(_prefixes(docs, n, percent, _sketch(docs, n)), "prefixes").frame

    nodes = known.where("node is not null").select("node", F.col("n_shingles").alias("n"), "prefix").dropDuplicates(["node"])
    entries = nodes.select("node", "n", F.posexplode("prefix").alias("at", "gram")).withColumn("at", F.col("at") + 1)
    repeated = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    columns = entries.join(repeated, "gram").select("gram", "node", "n", "at", (F.col("held") > HOT).alias("hot"))
    columns = stage(columns, "columns").frame

    ids = known.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    roots = components(_links(docs, n, columns, ids.select("node", F.col("least").alias("doc_id")), percent))
    grouped = ids.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return known.drop("prefix").join(named.select("node", "root", "component_id"), "node", "left")


def join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document.

    Two documents link when their sets' intersection is at least ``percent`` hundredths of the union; component_id is the
    smallest doc_id that links reach.
    """
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _grouped(docs, n, percent).select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each_group(df: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each component: that with the smallest key (nulls first), of equal keys with the smallest text hash.

    Of rows with one key and one text any one stays.  Rows without words are in no component and all stay.  Only rows that may
    have to go are shuffled.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    plain = F.col(f"`{text}`").cast("string")
    groups = stage(
        _grouped(df.select(F.col(f"`{key}`").alias("doc_id"), plain.alias("text")), n, percent).where("node is not null"), "groups"
    ).frame
    mark = F.xxhash64("doc_id", "t")
    rows = groups.groupBy("root", "doc_id", "t").agg(F.count(F.lit(1)).alias("copies"))
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "t")).alias("first"))
    judged = rows.join(first, "root").withColumn("stays", F.struct("doc_id", "t").eqNullSafe(F.col("first")))
    suspects = stage(
        judged.where("not stays or copies > 1").select(mark.alias("mark"), "doc_id", "t", "stays"), "suspects"
    ).frame

    row = df.select(F.struct(*columns).alias("row"), F.col(f"`{key}`").alias("doc_id"), F.xxhash64(plain).alias("t"))
    some, rest = concerned(row.withColumn("mark", mark), suspects, "mark")
    same = [F.col("a.mark") == F.col("b.mark"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), F.col("a.t") == F.col("b.t")]
    met = some.alias("a").join(suspects.alias("b"), same, "left").select("a.row", "a.mark", "a.doc_id", "a.t", "b.stays")
    once = met.where("stays").dropDuplicates(["mark", "doc_id", "t"])
    kept = rest.select("row").union(met.where("stays is null").select("row")).union(once.select("row"))
    return kept.select("row.*")

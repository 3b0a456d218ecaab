"""Removal of repeated byte strings by suffix arrays: every byte that a string of LENGTH bytes covers goes if that string starts
anywhere else as well, in the same text or in another.

1. *Regions.*  Every window of LENGTH bytes chooses its smallest hash of ``gram(LENGTH)`` bytes as anchor.  Equal windows choose the same
   anchor at the same place in them, so neighbouring windows of one anchor form a region, and only regions whose anchors
   have equal hashes can hold equal windows.
2. *Equal regions* (equal hashes of anchor and content) are counted; all windows of one that occurs twice are repeated.
3. *Suffix arrays.*  The distinct regions of each anchor hash that has several go to shards.  Induced sorting makes a shard's suffix
   array; permuted common prefixes of at least LENGTH bytes tell the windows that regions share in part.
4. *Anchors with more than CROWD distinct regions, or KEY_BYTES of them* (a line that every text has) do not go to one shard.  Their regions are
   cut into pieces of at most WIDTHS[0] windows, keyed by the bytes that all windows of a piece have in common; which leaves
   few.  Distinct pieces of one key go to shards like regions; only where they are a crowd again are they cut into narrower
   ones, down to single windows, keyed by all their bytes.  A piece's windows are in one piece at each width.  The bytes of
   these regions are written once, so texts are read once for all widths.
5. *Removal.*  Repeated windows of each text are united, and the text is joined to them.

Texts travel only if they are concerned: a filter of fixed size holds their hashes (it lets more through as it fills).
Python sees no text for that, and makes its rows in batches of OUT_BYTES, so that a task's memory doesn't depend on the tables.

Defined results: null text counts as empty; texts of fewer than LENGTH bytes lose nothing; repeated rows repeat each other; other
columns are kept, whatever their names.  What is left can end in the middle of a character, so it is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import suffix
from tidemark.llm.common import chunks, free_name, marked_by, tasks
from tidemark.session import stage

#: Windows of a text that are worked on at once.
STRETCH = 4_000_000
#: Distinct regions of one anchor hash that may go to one shard.
CROWD = 2_048
#: Windows of a piece, from cut to cut, each a multiple of the next.  Those above half the length are left out.
WIDTHS = (144, 48, 16, 4, 1)
#: Bytes of a shard, about, and bytes of one anchor hash's distinct regions that may go to one shard.
SHARD_BYTES, KEY_BYTES = 700_000, 350_000
#: Bytes of regions, and pieces, that a task hands on at once.
OUT_BYTES, OUT_ROWS = 2_000_000, 8_192

_SEPARATOR = 0xFE  # bytes of UTF-8, each raised by one, never reach it


def gram(length: int) -> int:
    """Bytes of an anchor: a power of two, a third of the window at most.  Long anchors are seldom equal by chance."""
    return 1 << ((length // 3).bit_length() - 1)


def _hashes(b: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes at each position."""
    h, width, factor = b.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < size:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = width * 2, factor * factor % (1 << 64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _anchors(h: np.ndarray, width: int) -> np.ndarray:
    """The position of the smallest hash among ``width`` ones from each position on, the leftmost of equals."""
    keys = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    least = np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def regions(b: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, content, first, last, anchor) of all regions of a text, a stretch at a time; windows first to last, inclusive."""
    for start in range(0, len(b) - length + 1, STRETCH):
        part = b[start : start + STRETCH + length - 1]
        h = _hashes(part, gram(length))
        at = _anchors(h, length - gram(length) + 1)
        firsts = np.flatnonzero(np.diff(at, prepend=-1))
        lasts = np.append(firsts[1:], len(at)) - 1
        raw = memoryview(part)
        content = [
            xxhash.xxh64_intdigest(raw[f : e + length]) for f, e in zip(firsts.tolist(), lasts.tolist())
        ]
        anchor = at[firsts]
        yield (
            h[anchor].view(np.int64), np.array(content, np.uint64).view(np.int64), firsts + start, lasts + start, anchor + start,
        )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _described(docs: DataFrame, length: int) -> DataFrame:
    """(t, size, key, content, first, last, anchor) of the regions of all texts."""
    names = ["t", "size", "key", "content", "first", "last", "anchor"]

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                rows: list[list[np.ndarray]] = [[] for _ in names]
                for t, text in zip(part.column("t").to_pylist(), part.column("text").to_pylist(), strict=True):
                    b = _bytes(text)
                    for found in regions(b, length):
                        n = len(found[0])
                        for column, values in zip(rows, (np.full(n, t), np.full(n, len(b)), *found), strict=True):
                            column.append(values)
                if rows[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in rows], names=names)

    return docs.select("t", "text").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _with_texts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(text, items): the ``items`` (t, size and others) of each text, with the text.  A text travels once, however many copies it has."""
    listed = items.groupBy("t", "size").agg(F.collect_list(F.struct(*[c for c in items.columns if c not in ("t", "size")])).alias("items"))
    once = marked_by(docs, items, "t")(True).groupBy("t", "size").agg(F.first("text").alias("text"))
    return once.join(listed.hint("merge"), ["t", "size"]).select("text", "items")


def _cut(docs: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """The ``items`` (t, size, first, last and other whole numbers) with the bytes of their windows, raw, for t and size."""
    names = [c for c in items.columns if c not in ("t", "size")]

    def run(batches):
        for found in batches:
            for part in chunks(found, "text"):
                listed = part.column("items")
                columns = dict(zip(names, listed.flatten().flatten(), strict=True))
                firsts, ends = columns["first"].to_pylist(), (columns["last"].to_numpy() + length).tolist()

                def batch(raws, end, columns=columns):
                    cut = [c.slice(end - len(raws), len(raws)) for c in columns.values()]
                    return pa.RecordBatch.from_arrays([*cut, pa.array(raws, pa.binary())], names=[*names, "raw"])

                raws, size, i = [], 0, 0
                for text, n in zip(part.column("text"), listed.value_lengths().to_pylist(), strict=True):
                    b = text.as_py().encode()
                    for i in range(i, i + n):  # noqa: B020
                        raws.append(b[firsts[i] : ends[i]])
                        size += len(raws[-1])
                        if size > OUT_BYTES:
                            yield batch(raws, i + 1)
                            raws, size = [], 0
                    i += 1
                yield batch(raws, i)

    return _with_texts(docs, items).mapInArrow(run, ", ".join([*(f"{n} bigint" for n in names), "raw binary"]))


def _shard_repeats(found: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int, int, int]]:
    """(key, content, first, last) of the windows of a shard's regions that start elsewhere in the shard."""
    parts, starts, at = [], [], 0
    for _, _, raw in found:
        parts += [np.frombuffer(raw, np.uint8) + np.uint8(1), np.array([_SEPARATOR], np.uint8)]
        starts.append(at)
        at += len(raw) + 1
    t = np.concatenate([*parts, np.zeros(1, np.uint8)])
    first = np.array(starts)
    windows = np.array([len(raw) - length + 1 for _, _, raw in found])
    edges = np.zeros(len(t) + 1, np.int32)
    edges[first] += 1
    np.subtract.at(edges, first + windows, 1)
    valid = np.cumsum(edges[:-1], dtype=np.int32) > 0

    previous, common = suffix.permuted_common_prefixes(t, suffix.suffix_array(t), first, 2 * length)  # a region is shorter
    again = valid & (common >= length)
    again[previous[again]] = True
    change = np.diff(again.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1) - 1
    region = np.searchsorted(first, begin, side="right") - 1
    return [
        (found[r][0], found[r][1], b - starts[r], e - starts[r])
        for r, b, e in zip(region.tolist(), begin.tolist(), end.tolist(), strict=True)
    ]


_WINDOWS = "key bigint, content bigint, start bigint, end bigint"


def _from_shards(slices: DataFrame, shards: int, length: int) -> DataFrame:
    """(key, content, start, end): repeated windows of regions, from their first one, by suffix arrays."""

    def run(batches):
        waiting: list[tuple[int, int, bytes]] = []
        size = 0

        def flush():
            rows = _shard_repeats(waiting, length) if waiting else []
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "content", "start", "end"])

        for batch in batches:
            for key, content, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if size > SHARD_BYTES and key != waiting[-1][0]:
                    yield flush()
                    waiting, size = [], 0
                waiting.append((key, content, raw))
                size += len(raw)
        yield flush()

    return slices.repartition(shards, "key").sortWithinPartitions("key").mapInArrow(run, _WINDOWS)


_PIECES = "key bigint, content bigint, region bigint, region_content bigint, start bigint, windows bigint, n bigint"


_REGION = ["region", "region_content", "start", "windows", "anchor", "n", "raw"]


def _pieces(found: DataFrame, width: int, length: int) -> DataFrame:
    """Pieces of at most ``width`` windows of what ``found`` (_REGION) has of its regions: ``windows`` of them from ``start`` on.

    Pieces go by the windows' distance from the anchor.  The key is made of the anchor's hash, the distance, and the bytes
    that all windows of these distances have in common.  Places are counted from the region's first byte.
    """
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def batch(rows):
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches):
        for part in batches:
            rows = []
            for region, region_content, start, windows, anchor, n, text in zip(*part.columns, strict=True):
                region, anchor, raw = region.as_py(), anchor.as_py(), text.as_py()
                far = anchor - start.as_py()
                near = far - windows.as_py() + 1
                for k in range(near // width, far // width + 1):
                    low, high = max(near, k * width), min(far, (k + 1) * width - 1)
                    common = raw[anchor - k * width : anchor - (k + 1) * width + 1 + length]
                    key = xxhash.xxh64_intdigest(common, seed=(region + k) % (1 << 64))
                    content = xxhash.xxh64_intdigest(raw[anchor - high : anchor - low + length], seed=high << 20 | low)
                    rows.append((_signed(key), _signed(content), region, region_content.as_py(), anchor - high, high - low + 1, n.as_py()))
                if len(rows) > OUT_ROWS:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    return found.select(*_REGION).mapInArrow(run, _PIECES)


def _is_crowd(kinds: str, bytes_: str) -> Column:
    """Whether a key has too many distinct regions or pieces for one shard."""
    return (F.col(kinds) > CROWD) | (F.col(bytes_) > KEY_BYTES)


def _sharded(docs: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """(key, content, start, end): repeated windows of the items (t, size, key, content, first, last), by suffix arrays."""
    amount = items.agg(F.sum(F.col("last") - F.col("first") + length)).first()[0] or 0
    slices = _cut(docs, items, length).select("key", "content", "raw")
    return _from_shards(slices, tasks(docs, amount // SHARD_BYTES + 1), length)


def _from_crowds(docs: DataFrame, crowded: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many distinct regions for one shard, by cutting the regions until they are no crowd."""
    items = crowded.select(
        "t", "size", F.col("key").alias("region"), F.col("content").alias("region_content"), "first", "last",
        (F.col("anchor") - F.col("first")).alias("anchor"), "n",
    )
    windows = (F.col("last") - F.col("first") + 1).alias("windows")
    cut = _cut(docs, items, length).withColumns({"start": F.lit(0).cast("bigint"), "windows": windows})
    open_ = regions_ = stage(cut.select(*_REGION), "crowded").frame
    end = (F.col("start") + F.col("windows") - 1).alias("end")
    found, shared = [], []
    for width in [w for w in WIDTHS if 2 * w <= length]:
        pieces = stage(_pieces(open_, width, length), "pieces").frame
        counted = pieces.groupBy("key", "content").agg(F.sum("n").alias("times"), F.first("windows").alias("each"))
        size = F.sum(F.col("each") + length - 1).alias("bytes")
        kinds = counted.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), size).withColumn("crowd", _is_crowd("kinds", "bytes"))
        judged = pieces.join(counted.drop("each"), ["key", "content"]).join(kinds.drop("bytes"), "key")
        judged = stage(judged.where("times > 1 or kinds > 1"), "judged").frame
        found.append(
            judged.where("times > 1").select(F.col("region").alias("key"), F.col("region_content").alias("content"), "start", end)
        )
        # A piece that differs from others under its key can share some of its windows with them.
        shared.append(judged.where("kinds > 1 and not crowd"))
        wide = judged.where("kinds > 1 and crowd").select("region", "region_content", "start", "windows")
        if wide.isEmpty():
            break
        open_ = wide.join(regions_.drop("start", "windows"), ["region", "region_content"])
    some = reduce(DataFrame.union, shared)
    one = some.groupBy("key", "content").agg(F.min(F.struct("region", "region_content", "start", "windows")).alias("one"))
    one = stage(one.select("key", "content", "one.*"), "narrow").frame
    size = F.col("windows") - 1 + length
    amount = one.agg(F.sum(size)).first()[0]
    if amount:
        raw = F.substring("raw", F.col("start").cast("int") + 1, size.cast("int")).alias("raw")
        slices = one.join(regions_.select("region", "region_content", "raw"), ["region", "region_content"]).select("key", "content", raw)
        again = _from_shards(slices, tasks(docs, amount // SHARD_BYTES + 1), length)
        again = again.select("key", "content", F.col("start").alias("from"), F.col("end").alias("to"))
        found.append(
            some.join(again, ["key", "content"]).select(
                F.col("region").alias("key"), F.col("region_content").alias("content"),
                (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end"),
            )
        )
    return stage(reduce(DataFrame.union, found), "crowds").frame


def find(docs: DataFrame, length: int = 400) -> DataFrame:
    """(t, size, windows): the repeated windows of each text that has some, by region: array<struct<first, parts>>, parts an
    array<struct<start, end>> of windows counted from the region's first one, inclusive.

    ``docs``: t (hash of the text), size (bytes) and text.
    """
    if length < 24:
        raise ValueError("length is at least 24")
    described = stage(_described(docs.where(F.col("size") >= length), length), "regions").frame
    counted = described.groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "size", "first", "last", "anchor")).alias("at")
    )
    size = F.sum(F.col("at.last") - F.col("at.first") + length)
    kinds = counted.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"), size.alias("bytes"))
    crowd = _is_crowd("kinds", "bytes").alias("crowd")
    several = kinds.where("total > 1").select("key", "kinds", crowd)
    known = stage(counted.join(several, "key").select("key", "content", "n", "kinds", "crowd", "at.*"), "known").frame

    whole = known.where("n > 1").select(
        "key", "content", F.lit(0).cast("bigint").alias("start"), (F.col("last") - F.col("first")).alias("end"),
        F.lit(True).alias("whole"),
    )
    part = F.lit(False).alias("whole")
    differing = known.where("kinds > 1 and not crowd")
    items = differing.select("t", "size", "key", "content", "first", "last")
    repeated = whole.union(_sharded(docs, items, length).select("*", part))
    crowded = known.where("kinds > 1 and crowd")
    if not crowded.isEmpty():
        repeated = repeated.union(_from_crowds(docs, crowded, length).select("*", part))
    # One row for each region, so the join gives no more rows than there are regions; a whole one needs no parts.
    parts = F.collect_set(F.when(~F.col("whole"), F.struct("start", "end")))
    by_region = repeated.groupBy("key", "content").agg(
        F.max(F.when(F.col("whole"), F.col("end"))).alias("all_to"), parts.alias("parts")
    )
    zero = F.lit(0).cast("bigint")
    all_of_it = F.array(F.struct(zero.alias("start"), F.col("all_to").alias("end")))
    chosen = F.when(F.col("all_to").isNotNull(), all_of_it).otherwise(F.col("parts")).alias("parts")
    by_region = stage(by_region.select("key", "content", chosen), "repeated").frame
    return (
        described.join(by_region, ["key", "content"])
        .groupBy("t", "size")
        .agg(F.collect_set(F.struct("first", "parts")).alias("windows"))
    )


def _spans(windows: list | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes (end exclusive) that windows cover."""
    out: list[list[int]] = []
    found = [(w["first"] + p["start"], w["first"] + p["end"]) for w in windows or [] for p in w["parts"]]
    for start, end in sorted(found):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end + length)
        else:
            out.append([start, end + length])
    return [(s, e) for s, e in out]


def remove(df: DataFrame, length: int = 400, text: str = "text", keep: list[str] | None = None, digest: bool = False) -> DataFrame:
    """``keep``'s columns (all) with n_bytes, n_removed, n_spans, and what is left of the text.

    That is ``kept``, bytes, and ``spans``, array<struct<start, end>>; or with ``digest`` only the SHA-256 of ``kept``.
    """
    keep = df.columns if keep is None else keep
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), plain.alias("text")).select(
        "row", F.xxhash64("text").alias("t"), F.octet_length("text").cast("bigint").alias("size"), "text"
    )
    windows = stage(find(docs.select("t", "size", "text"), length), "windows").frame
    chosen = marked_by(docs, windows, "t")

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                sizes, removed, numbers, spans, kept = [], [], [], [], []
                listed = part.column("windows") if "windows" in part.schema.names else pa.nulls(part.num_rows)
                for text, found in zip(part.column("text"), listed, strict=True):  # one text's windows at a time
                    raw = text.as_py().encode()
                    cut = _spans(found.as_py(), length)
                    edges = [0, *(x for span in cut for x in span), len(raw)]
                    left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    sizes.append(len(raw))
                    removed.append(len(raw) - len(left))
                    numbers.append(len(cut))
                    spans.append([{"start": a, "end": b} for a, b in cut])
                    kept.append(hashlib.sha256(left).hexdigest() if digest else left)
                arrays = [part.column("row"), *(pa.array(x, pa.int64()) for x in (sizes, removed, numbers))]
                if not digest:
                    arrays.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
                arrays.append(pa.array(kept, pa.string() if digest else pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *made])

    made = ["n_bytes", "n_removed", "n_spans", *([] if digest else ["spans"]), "kept_sha256" if digest else "kept"]
    added = ", ".join(
        f"{c} {'array<struct<start:bigint,end:bigint>>' if c == 'spans' else 'string' if c == 'kept_sha256' else 'binary' if c == 'kept' else 'bigint'}"
        for c in made
    )
    schema = f"row {docs.schema['row'].dataType.simpleString()}, {added}"
    found = chosen(True).join(windows, ["t", "size"], "left").select("row", "text", "windows")
    out = found.mapInArrow(run, schema).union(chosen(False).select("row", "text").mapInArrow(run, schema))
    return out.select("row.*", *[F.col(c).alias(free_name(c, keep)) for c in made])

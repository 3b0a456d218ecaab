"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

Documents are read twice.  The first pass keeps, of every whole text, its number of terms and the places of those terms that
some item asks for (a forward index, written to the shared folder), and from it come the corpus statistics.  In the second
pass every task turns its documents, some thousands at a time, into posting lists and answers all items on them, one term
after another, rarest first:

1. while a document without an accumulator could still get among the best ``k``, a term's postings create accumulators;
2. once the bounds of the terms that remain add up to less than the kth partial score, no more are created: a document that
   holds none of the terms so far can't get there;
3. the accumulators that may still get there are updated with the remaining terms, exactly, and those that can't are let go.

A task keeps the best ``k`` of each item over all its documents, so that later documents meet a higher kth score.  Only these
are shuffled, at most ``k`` rows for each item and task, and ranked in two steps.

Items are answered in blocks of at most ``BLOCK_TERMS`` different terms (one item with more is a block of its own), so what is
sent to the tasks has a bound that follows neither the documents nor the number of items.

Defined results: a null or empty text has no terms, counts in no statistic and is never found; an item without text has no
rows.  Rows are documents: a repeated row is found as often as it is there, one with a null id comes after equal scores.  Each
row of items is answered by itself, whatever its id.  No documents or no items give no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

#: Different terms of the items that are answered together.
BLOCK_TERMS = 200_000

#: A task turns documents with about so many postings into lists at once.
POSTINGS = 2_000_000

#: Parts in which an item's candidates are ranked before they meet.
PARTS = 64

#: A-Z become a-z; 0-9 and all bytes of characters beyond ASCII stay; everything else separates.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_TERM_BYTES).split()


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """For each row of ``items`` (item_id, text) its ``k`` best rows of ``docs`` (doc_id, an integer, text).

    Returns item_id, rank, doc_id, score.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    found = [_ranked(_candidates(docs, block, k), block, k) for block in _blocks(items)]
    if not found:
        return _empty(items)
    answer = found[0]
    for other in found[1:]:
        answer = answer.unionByName(other)
    return answer


def _empty(items: DataFrame) -> DataFrame:
    kind = items.schema["item_id"].dataType.simpleString()
    return items.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


# -- items ------------------------------------------------------------------------------------------------------


class Block:
    """Items that are answered together: their ids and texts, and the terms of each with its repeats."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.ids, self.asked, self.vocabulary = [], [], {}

    def add(self, item_id, counts: Counter) -> None:
        self.ids.append(item_id)
        self.asked.append([(self.vocabulary.setdefault(t, len(self.vocabulary)), q) for t, q in counts.items()])


def _blocks(items: DataFrame) -> Iterator[Block]:
    """The items come to the driver one after another; a block holds no more than it may send to the tasks."""
    spark, schema = items.sparkSession, items.select("item_id").schema
    block = Block(spark, schema)
    for row in items.select("item_id", F.col("text").cast("string").cast("binary").alias("text")).toLocalIterator():
        counts = Counter(terms(bytes(row.text or b"")))
        if block.vocabulary and len(block.vocabulary) + len(counts) > BLOCK_TERMS:
            yield block
            block = Block(spark, schema)
        if counts:
            block.add(row.item_id, counts)
    if block.ids:
        yield block


# -- first pass: what each document holds of the terms that are asked for ---------------------------------------

def _forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, its number of terms, and of the terms asked for their numbers and counts; documents without terms go."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            kept, sizes, held, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(texts):
                words = terms(text.as_py() or b"")
                if not words:
                    continue
                found = Counter(map(number, words))
                found.pop(None, None)
                kept.append(i)
                sizes.append(len(words))
                held.extend(found)
                counts.extend(found.values())
                ends.append(len(held))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (held, counts)]
            columns = [ids.take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


# -- second pass ------------------------------------------------------------------------------------------------


class Corpus:
    """What scores need to know of all documents."""

    def __init__(self, forward: DataFrame, terms_asked: int):
        total = forward.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        self.documents, self.length = total.n, total.l or 0
        # At most one row for each term of the block.
        rows = forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
        self.weights = np.zeros(terms_asked, np.int64)
        for r in rows:
            self.weights[r.t] = math.floor(1000 * math.log((2 * self.documents + 2) / (2 * r["count"] + 1)))

    def measure(self, n: np.ndarray) -> np.ndarray:
        """m of documents with ``n`` terms each."""
        if 25 * int(n.max()) * self.documents < 2**63:
            return 75 + 25 * n * self.documents // self.length
        return np.array([75 + 25 * int(x) * self.documents // self.length for x in n], np.int64)


class Lists:
    """Posting lists of some documents: for each term the documents, ascending, and what they gain by it."""

    def __init__(self, n: np.ndarray, ends: np.ndarray, held: np.ndarray, counts: np.ndarray, corpus: Corpus):
        self.size = len(n)
        owner = np.repeat(np.arange(self.size, dtype=np.int32), np.diff(ends))
        tf = counts.astype(np.int64)
        gain = corpus.weights[held] * (1_000_000_000 * tf // (1000 * tf + 12 * corpus.measure(n)[owner]))
        order = np.argsort(held, kind="stable")  # keeps documents ascending within a term
        self.docs, self.gain = owner[order], gain[order]
        self.start = np.searchsorted(held[order], np.arange(len(corpus.weights) + 1))
        self.bound = np.zeros(len(corpus.weights), np.int64)
        there = self.start[:-1] < self.start[1:]
        self.bound[there] = np.maximum.reduceat(self.gain, self.start[:-1][there]) if len(gain) else 0

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.start[term], self.start[term + 1]
        return self.docs[a:b], self.gain[a:b]


def best(lists: Lists, asked: list[tuple[int, int]], k: int, floor: int, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (positions, ascending) that may be among the best ``k``, with their exact scores.

    ``asked``: terms with their repeats, rarest first.  ``floor``: a score that ``k`` documents seen before have at least.
    ``score``: zeros, one for each document; zeros again afterwards.
    """
    asked = [(t, q) for t, q in asked if lists.bound[t] > 0]
    bounds = np.array([q * int(lists.bound[t]) for t, q in asked], np.int64)
    left = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # left[i]: what terms i and later can add at most
    kth, i = floor, 0
    # Accumulators are created while a document without one could reach the kth score.
    while i < len(asked) and left[i] >= kth:
        term, repeats = asked[i]
        docs, gain = lists.of(term)
        score[docs] += repeats * gain
        i += 1
        if left[0] - left[i] > left[i] and lists.size >= k:  # else no partial score can be beyond what is left
            kth = max(kth, int(np.partition(score, lists.size - k)[lists.size - k]))
    touched = alive = np.flatnonzero(score)
    # Survivors only, exactly.
    for (term, repeats), rest in zip(asked[i:], left[i:], strict=False):
        alive = alive[score[alive] + rest >= kth]
        docs, gain = lists.of(term)
        if len(alive) * 16 < len(docs):
            at = np.searchsorted(docs, alive)
            at[at == len(docs)] = 0
            hit = docs[at] == alive
            score[alive[hit]] += repeats * gain[at[hit]]
        else:
            chosen = np.zeros(lists.size, bool)
            chosen[alive] = True
            hit = chosen[docs]
            score[docs[hit]] += repeats * gain[hit]
        if len(alive) > k:
            kth = max(kth, int(np.partition(score[alive], len(alive) - k)[len(alive) - k]))
    alive = alive[(score[alive] >= kth) & (score[alive] > 0)]
    scores = score[alive]
    score[touched] = 0
    return alive, scores


class Best:
    """The best ``k`` of an item so far: scores, ids (a missing one comes last) and whether there is an id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = (np.append(a, b) for a, b in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


def _candidates(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """item (its position in the block), doc_id, score: the best of each task."""
    forward = stage(_forward(docs, block.vocabulary), "forward").frame
    corpus = Corpus(forward, len(block.vocabulary))
    if not corpus.documents:
        return forward.select(F.lit(0).alias("item"), "doc_id", F.col("n").alias("score"))
    rarest_first = [sorted(asked, key=lambda tq: (-corpus.weights[tq[0]], tq[0])) for asked in block.asked]
    shared = docs.sparkSession.sparkContext.broadcast((corpus, rarest_first))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, postings = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                held.append(part)
                postings += len(part.column("terms").flatten())
                if postings >= POSTINGS:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, postings = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, queries = shared.value
        tops = [Best(k) for _ in queries]
        for table in gathered(batches):
            column = {name: table.column(name).combine_chunks() for name in table.column_names}
            lengths = np.diff(column["terms"].offsets.to_numpy())
            ends = np.append(0, np.cumsum(lengths))
            held, counts = (column[c].flatten().to_numpy() for c in ("terms", "counts"))
            lists = Lists(column["n"].to_numpy(), ends, held, counts, corpus)
            known = column["doc_id"].is_valid().to_numpy(zero_copy_only=False)
            ids = column["doc_id"].fill_null(0).to_numpy()
            score = np.zeros(lists.size, np.int64)
            for top, asked in zip(tops, queries, strict=True):
                docs, scores = best(lists, asked, k, top.floor, score)
                if len(docs):
                    top.add(scores, ids[docs], known[docs])
        for i, top in enumerate(tops):
            if len(top.ids):
                ids = pa.array(top.ids, mask=~top.known)
                item = pa.array(np.full(len(top.ids), i, np.int32))
                yield pa.RecordBatch.from_arrays([item, ids, pa.array(top.scores)], names=["item", "doc_id", "score"])

    return forward.mapInArrow(run, "item int, doc_id long, score long")


def _ranked(candidates: DataFrame, block: Block, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = candidates.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS)))
    for parts in (["item", "part"], ["item"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
        salted = salted.where(F.col("rank") <= k)
    kind = block.schema["item_id"].dataType.simpleString()
    named = block.spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind}")
    return salted.join(named, "item").select("item_id", "rank", "doc_id", "score")

"""Spelling variants: words of a corpus one edit apart, found by walking a trie whose nodes and edges are tables.

The trie of all words is a table of edges (node, first character, label, child).  Only places where words part are nodes, so
a label may have many characters; a node's name is the hash of the prefix it stands for.  Every word ends in a mark of its
own, so each ends in a leaf.

The frontier is a table of states (word, position, node, edits).  Level by level it is joined with the edges:

* a state goes on over the edge that its word continues with, if the whole label agrees;
* a state without an edit also goes over every *other* edge of its node, by spending its edit on the character where word and
  edge part: replaced, left out of the word, or put into it.

A state with one edit that reaches a leaf with its word used up has found a neighbour.  Where two words first differ they part
in a node, so nothing else has to be tried.  So that a node near the root isn't met by every word with all its edges, there
are two tries, of the words and of the words read backwards, and a word may spend its edit in the second half of either
only: each state starts at the first node behind the middle.  An edit in the first half is one in the second half of the word
read backwards.

The loop runs until the frontier is empty, which is after as many levels as nodes follow each other on a path, not after as
many as a word has characters.  Each level is written to the shared folder and read again.

Defined results: a null or empty text has no words; a null id counts as an empty text in the rule that plants slips.
Repeated rows count as often as they are there.  Words of equal count are chosen by code points.  Empty tables give no rows,
other columns are not read.  Nodes are compared by 61-bit hashes, and every pair found is checked by its edit distance.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks
from tidemark.session import stage

#: A task's words are handed on when there are so many different ones.
HELD = 200_000

#: Ends every word in the trie; no word holds it.
END = "$"

_MODULUS, _BASE = (1 << 61) - 1, 1_000_003

#: In Latin-1: letters stay, A-Z become a-z, all else separates.  Characters beyond Latin-1 are written as a question mark.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """The runs of letters of a text, A-Z lower-cased, one byte for each code point."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def slip(doc_id: int | None, run: bytes, every: int) -> bytes:
    """The run with one code point left out, if the hash of document and run says so."""
    name = b"" if doc_id is None else b"%d" % doc_id
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(name + b":"))
    return run if h % every else run[: (at := h % len(run))] + run[at + 1 :]


def words(docs: DataFrame, least_length: int = 6, least: int = 5, slips: int | None = None) -> DataFrame:
    """word, n: the runs of letters in all texts, of at least that length and that many times there.

    ``slips``: leave a code point out of one run in so many, chosen by hash of document and run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            spelled = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([spelled, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in chunks(batch, "text"):
                for doc_id, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                    for word, n in Counter(runs(text or "")).items():
                        word = slip(doc_id, word, slips) if slips else word
                        if len(word) >= least_length:
                            total[word] += n
                if len(total) > HELD:
                    yield counted()
                    total = Counter()
        if total:
            yield counted()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- the trie ---------------------------------------------------------------------------------------------------


def _prefix_hashes(text: str) -> list[int]:
    """The hash of every proper prefix, the empty one first."""
    return list(accumulate((ord(c) for c in text[:-1]), lambda h, c: (h * _BASE + c) % _MODULUS, initial=1))


def middle(length: int, side: int) -> int:
    """Where a word's second half begins, to and fro."""
    return length // 2 if side == 0 else length - length // 2


def _prefixes(vocabulary: DataFrame) -> DataFrame:
    """id, side, depth, node, next: the places in each word and the character that follows; twice, to and fro.

    Only places from one before the middle on, as edits happen behind the middle and a word's neighbours have theirs at most
    one place off; so short prefixes, which many words share, need not be told.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sides, depths, nodes, after = [], [], [], [], []
            for i, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
                for side, text in enumerate((word + END, word[::-1] + END)):
                    least = max(0, middle(len(word), side) - 1)
                    ids += [i] * (len(text) - least)
                    sides += [side] * (len(text) - least)
                    depths += range(least, len(text))
                    nodes += [h * 2 + side for h in _prefix_hashes(text)[least:]]
                    after += text[least:]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sides, pa.int32()), pa.array(depths, pa.int32()),
                 pa.array(nodes, pa.int64()), pa.array(after, pa.string())],
                names=["id", "side", "depth", "node", "next"],
            )

    return vocabulary.select("id", "word").mapInArrow(run, "id long, side int, depth int, node long, next string")


def trie(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (node, first, label, child, leaf) and where the words' walks start (id, rest, node).

    ``vocabulary``: id, word.  ``leaf`` is the id of the word that ends there, else null; ``child`` is null there.
    """
    places = stage(_prefixes(vocabulary), "places").frame
    nodes = places.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b")).where("a <> b").select("node")
    nodes = stage(nodes, "nodes").frame  # so that the join splits a node that many words pass
    # A word's places in nodes, in their order: as many as words part on its way.
    passed = F.sort_array(F.collect_list(F.struct("depth", "node")))
    path = places.join(nodes, "node").groupBy("id", "side").agg(passed.alias("path"))
    spelled = F.concat(F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")), F.lit(END))
    walks = vocabulary.join(path, "id").select("id", spelled.alias("spelled"), "side", "path")
    walks = stage(walks, "walks").frame

    step = walks.select("id", "spelled", "path", F.posexplode("path").alias("i", "at"))
    child = F.try_element_at("path", F.col("i") + 2)  # counted from 1, the one after this
    ends = F.coalesce(child["depth"], F.length("spelled"))
    label = F.substring(F.col("spelled"), F.col("at.depth") + 1, ends - F.col("at.depth"))
    edges = step.select(
        F.col("at.node").alias("node"),
        F.substring(label, 1, 1).alias("first"),
        label.alias("label"),
        child["node"].alias("child"),
        F.when(child.isNull(), F.col("id")).alias("leaf"),
    ).dropDuplicates(["node", "first"])  # words that pass there agree up to the next node

    length = F.length("spelled") - 1
    half = F.floor(length / 2)
    behind = F.when(F.col("side") == 0, half).otherwise(length - half)
    start = F.try_element_at(F.filter("path", lambda p: p["depth"] >= behind), F.lit(1))
    starts = walks.select("id", "spelled", start.alias("at")).where("at is not null")
    return edges, starts.select("id", F.expr("substring(spelled, at.depth + 1)").alias("rest"), F.col("at.node").alias("node"))


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """id, near: pairs of words (id, word; words are distinct) that one inserted, deleted or replaced character makes equal."""
    edges, starts = trie(vocabulary)
    edges = stage(edges, "edges").frame
    frontier = starts.withColumn("edits", F.lit(0))
    found = []
    while True:
        level = stage(_advance(frontier, edges), "level").frame
        reached = (F.col("edits") == 1) & F.col("leaf").isNotNull() & (F.col("rest") == "")
        found.append(level.where(reached).select("id", F.col("leaf").alias("near")))
        frontier = level.where(F.col("node").isNotNull() & (F.col("rest") != "")).drop("leaf")
        if frontier.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _advance(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """id, rest, node, edits, leaf: the states one edge further."""
    state = frontier.withColumn("first", F.substring("rest", 1, 1))
    label, rest = F.col("label"), F.col("rest")

    def without(text: str, n: int) -> str:
        return f"substring({text}, {n + 1})"

    on = state.join(edges, ["node", "first"]).where(F.startswith(rest, label))
    onward = F.expr("substring(rest, length(label) + 1)").alias("rest")
    straight = on.select("id", onward, F.col("child").alias("node"), "edits", "leaf")

    # (what the word has left, what the edge has left) once the edit is spent where they part
    ways = [(without("rest", 1), without("label", 1)), ("rest", without("label", 1)), (without("rest", 1), "label")]
    tried = ", ".join(f"if(startswith({r}, {e}), substring({r}, length({e}) + 1), null)" for r, e in ways)
    other = edges.withColumnRenamed("first", "other")
    off = state.where("edits = 0").join(other, "node").where("first <> other")
    rests = F.expr(f"array_distinct(filter(array({tried}), x -> x is not null))")
    edited = off.select("id", F.explode(rests).alias("rest"), F.col("child").alias("node"), F.lit(1).alias("edits"), "leaf")
    return straight.unionByName(edited)


# -- variants ---------------------------------------------------------------------------------------------------


def variants(counted: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n for words with their counts (word, n).

    A word's form is its near word of largest count, if that is at least ``times`` the word's own; its root is where its
    forms lead.
    """
    numbered = stage(counted.select(F.xxhash64("word").alias("id"), "word", "n"), "words").frame
    near = numbered.select(F.col("id").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    pairs = neighbours(numbered.select("id", "word")).join(near, "near").join(numbered, "id")
    pairs = pairs.where(F.levenshtein("word", "near_word") == 1)
    # The first of (-n, word): the largest count, then the smallest word.
    largest = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("word")))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), largest.alias("best"))
    joined = numbered.select("word", "n").join(best, "word", "left")
    strong = -F.col("best.less") >= times * F.col("n")
    formed = joined.select(
        "word",
        F.when(strong, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    )
    formed = stage(formed, "forms").frame
    return formed.join(_roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(formed: DataFrame) -> DataFrame:
    """word, root for the words that have a form.  Every round doubles how far the links reach."""
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        longer = stage(longer, "roots").frame
        links = longer.select("word", "root")
        if longer.where("further is not null").isEmpty():
            return links

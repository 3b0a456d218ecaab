"""I-Match fingerprints: hashes of a text's informative terms under randomised subsets of the lexicon.

The lexicon holds the terms whose document frequency lies in a band, neither in nearly every text nor in hardly any.  All texts are
counted, by hash cells: the number of cells is fixed, so the lexicon is a bit array of half a megabyte however large the corpus
is.  (A cell's terms count together.  With CELLS far above the terms of a text, what other terms add to a cell stays far
below the band's lower end, at any number of documents.)

Each term of the lexicon belongs to one of CLASSES random classes by its hash, and each class is a subset.  A fingerprint lists, for
each subset that has terms in the text, the hash of the sorted distinct ones, and the hash of all terms of the lexicon.  Texts
with equal entries agree on a whole subset; the likeness of two fingerprints is the share of equal entries among all.

Only DataFrame functions are used.

Defined results: null text counts as empty; a text without terms of the lexicon has one entry, of all its terms; a text without
terms has one of the text itself.  The next document is the next row by id (nulls first), rows of equal id by the text's hash;
after the last row comes the first.  Repeated rows keep their number; columns beyond id and text take no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, tasks
from tidemark.session import stage

#: Hash cells of terms.
CELLS = 1 << 22
#: Shares of documents between which a term belongs to the lexicon.
BAND = (0.0005, 0.1)
#: Random classes of the lexicon's terms, a power of two.  All are subsets, so every term of the lexicon enters one; a text of
#: usual length has one term or a few in most, so an entry stands for several terms and an edit leaves many entries.
CLASS_BITS = 7
CLASSES = SUBSETS = 1 << CLASS_BITS

_TERM = r"[\p{L}\p{N}]+"


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct lower-case terms."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _cell(term: Column) -> Column:
    return term.bitwiseAND(F.lit(CELLS - 1))


def lexicon(texts: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """One row, one column: the bits of the cells in the band, 64 to a number."""
    cells = F.array_distinct(F.transform(term_hashes(F.col(text)), _cell))
    counts = texts.select(F.explode(cells).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("df"))
    n = texts.agg(F.count(F.lit(1))).scalar()
    inside = counts.where((F.col("df") >= band[0] * n) & (F.col("df") <= band[1] * n))
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    words = inside.groupBy(F.shiftright("cell", 6).alias("i")).agg(F.bit_or(bit).alias("bits"))
    spark = texts.sparkSession
    every = spark.range(CELLS // 64).withColumnRenamed("id", "i").join(words, "i", "left")
    ordered = F.sort_array(F.collect_list(F.struct("i", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.agg(F.transform(ordered, lambda x: x["bits"]).alias("lexicon"))


def fingerprint(text: Column, bits: Column) -> Column:
    """Entries of a text's fingerprint.  ``bits``: the lexicon, as a column."""

    def known(term: Column) -> Column:
        cell = _cell(term)
        word = F.get(bits, F.shiftright(cell, 6).cast("int"))
        return F.call_function("getbit", word, (cell % 64).cast("int")) == 1

    def digest(terms: Column) -> Column:
        return F.substring(F.md5(F.array_join(F.transform(terms, lambda t: F.hex(t)), ",").cast("binary")), 1, 6)

    def subset(term: Column) -> Column:
        return F.shiftrightunsigned(term, 64 - CLASS_BITS)  # the top bits; equal ones stand together when sorted

    def cut(terms: Column) -> Column:
        """Runs of one subset, as text between bars."""
        joined = F.array_join(
            F.transform(
                terms,
                lambda t, i: F.concat(
                    F.when((i > 0) & (subset(t) != subset(F.get(terms, i - 1))), F.lit("|,")).otherwise(F.lit(",")), F.hex(t)
                ),
            ),
            "",
        )
        return F.transform(F.split(joined, r"\|"), lambda p: F.substring(F.md5(p.cast("binary")), 1, 6))

    def entries(terms: Column) -> Column:
        def from_lexicon(found: Column) -> Column:
            return F.concat(F.array(F.concat(F.lit("l"), digest(found))), cut(found))

        whole = F.array(
            F.when(F.size(terms) > 0, F.concat(F.lit("a"), digest(F.sort_array(terms)))).otherwise(
                F.concat(F.lit("t"), F.substring(F.md5(text.cast("binary")), 1, 8))
            )
        )
        return let(
            F.sort_array(F.filter(terms, known)), lambda found: F.when(F.size(found) > 0, from_lexicon(found)).otherwise(whole)
        )

    return let(term_hashes(text), entries)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries of two fingerprints, 0 to 1."""

    def of(x: Column, y: Column) -> Column:
        return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))

    return of(a, b).cast("double")


def following(docs: DataFrame) -> DataFrame:
    """(g, null_id, k, h, n, next_k, next_h): every row's rank by id, its key and length, and the key of the next row.

    ``docs`` has null_id, k, h and n.  Ranks come from a sort into ranges whose rows are counted; no task sees all rows.
    """
    ranges = docs.select("null_id", "k", "h", "n").repartitionByRange(tasks(docs), F.desc("null_id"), "k", "h")
    ordered = ranges.sortWithinPartitions(F.desc("null_id"), "k", "h").withColumn("place", F.monotonically_increasing_id())
    ordered = stage(ordered, "order").frame
    part = F.shiftright("place", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))  # a row for each range
    ranked = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    ranked = ranked.select(
        (F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("g"), "null_id", "k", "h", "n"
    )
    total = ordered.agg(F.count(F.lit(1))).scalar()
    back = ranked.select(
        F.pmod(F.col("g") - 1, total).alias("g"), F.col("k").alias("next_k"), F.col("h").alias("next_h")
    )
    return ranked.join(back, "g")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    The edited text has the last quarter of the code points replaced by the first as many (or all) of the next document.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    null_id = F.col("doc_id").isNull()
    rows = docs.select("doc_id", text.alias("text")).select(
        F.col("doc_id"),
        null_id.alias("null_id"),
        "text",
        F.length("text").cast("bigint").alias("n"),
    )
    id_type = docs.schema["doc_id"].dataType
    zero = F.lit(0 if id_type.simpleString() in ("bigint", "int", "smallint") else "").cast(id_type)
    rows = rows.select(F.coalesce("doc_id", zero).alias("k"), F.xxhash64("text", "null_id").alias("h"), "null_id", "text", "n")
    order = stage(following(rows), "following").frame

    # Whole texts are shuffled once (both joins read the same exchange); the heads of the next texts travel to them.
    once = rows.groupBy("k", "h").agg(F.first("text").alias("text"))
    heads = (
        order.withColumnsRenamed({"k": "own_k", "h": "own_h", "next_k": "k", "next_h": "h"})
        .join(once, ["k", "h"])
        .withColumn("head", F.expr("left(text, cast(n div 4 as int))"))
        .drop("k", "h", "text")
        .withColumnsRenamed({"own_k": "k", "own_h": "h"})
    )
    both = heads.join(once, ["k", "h"])
    edited = F.concat(F.expr("left(text, cast(n - n div 4 as int))"), F.col("head"))
    spark, name = docs.sparkSession, f"lexicon_{uuid.uuid4().hex}"
    lexicon(rows.select("text")).createOrReplaceTempView(name)
    spark.sql(f"DECLARE VARIABLE {name} ARRAY<BIGINT>")
    spark.sql(f"SET VAR {name} = (SELECT lexicon FROM {name})")  # CELLS bits
    bits = F.expr(f"session.{name}")
    measured = both.select(
        "g",
        F.when(~F.col("null_id"), F.col("k")).alias("doc_id"),
        F.col("n").alias("n_chars"),
        "text",
        edited.alias("edited"),
    ).select(
        "g",
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), bits).alias("entries"),
        fingerprint(F.col("edited"), bits).alias("edited_entries"),
    )
    measured = measured.select(
        "g",
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.array_join("entries", " ").alias("fingerprint"),
        F.array_join("edited_entries", " ").alias("edited_fingerprint"),
        likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
    )
    measured = stage(measured, "fingerprints").frame
    spark.sql(f"DROP TEMPORARY VARIABLE {name}")
    spark.catalog.dropTempView(name)
    total = measured.agg(F.count(F.lit(1))).scalar()
    after = measured.select(F.pmod(F.col("g") - 1, total).alias("g"), F.col("fingerprint").alias("next"))
    near_next = likeness(F.split("fingerprint", " "), F.split("next", " "))
    return measured.join(after, "g").select(*measured.columns[1:], near_next.alias("near_next"))

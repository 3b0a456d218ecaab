"""Personal data: spans by pattern, and terms that give a protected value away.

Four kinds are found by pattern.  Then the corpus is asked how much the words of the texts that hold such a value tell
about it: for a value c and a term t that some text holds both, however far from each other, with N documents,

    IC(c) = log(N / n_c)          PMI(c, t) = log(N * n_ct / (n_c * n_t))

where n_c documents hold c, n_t hold t and n_ct hold both, anywhere in their texts.  PMI = IC means that whoever reads t
knows c.  A term with n_ct >= SUPPORT and PMI >= THRESHOLD * IC discloses its value.  With ``everywhere`` its places in
all texts become spans of kind ``term``, otherwise those within REACH characters of the value; ``sanitise`` generalises them
as it does the values.

Only DataFrame functions are used.  Positions come from marking the matches, cutting the text at the marks and summing
the pieces' lengths.  Counts combine before their shuffle, and the joins can be split by adaptive execution, so a value
or a term that a third of the rows hold is no bottleneck.  Pairs that no number of common texts can bring to the threshold go
before they are counted.  A bit array of fixed size picks the words that may be wanted before their places are joined; as it
fills, more words are joined, and results stay whole.

Defined results: null text counts as empty and has no spans; repeated rows are found each on its own; other columns are
kept, whatever their names; positions are code points, the end exclusive.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import FILTER_BITS, free_name, let
from tidemark.session import stage

#: The order of kinds with the same start.
KINDS = ("email", "ip", "card", "phone", "term")

# The kinds' patterns.  Possessive quantifiers and the look-behinds change no match; they spare useless attempts inside
# long runs.  The leftmost match can only start where a run starts, or right behind the last match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a match of the kind.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: Characters beside a value within which a disclosing term's places are marked, unless they are everywhere.
REACH = 64
#: Documents that must hold a term and its value.
SUPPORT = 2
#: Share of a value's information that a term may disclose.
THRESHOLD = 0.9
#: Letters of the shortest term.
SHORTEST = 3

_OPEN, _CLOSE, _NEUTRAL = "\x01", "\x02", "\x03"
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
_BESIDE = "array<struct<entity:bigint,term:bigint,start:int,end:int>>"


def running_sums(numbers: Column) -> Column:
    """Inclusive sums of an array of integers, block by block, so that long arrays are not copied for each element."""

    def scan(a: Column, start: Column) -> Column:
        return F.aggregate(a, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda acc, x: acc + x)

    def by_block(ns: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(ns))).cast("int")
        count = F.ceil(F.size(ns) / width).cast("int")
        cut = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(ns, b * width + 1, width))
        return let(
            cut,
            lambda blocks: let(
                scan(F.transform(blocks, total), F.lit(0)),
                lambda offsets: F.flatten(
                    F.transform(blocks, lambda b, i: F.slice(scan(b, F.get(offsets, i)), F.lit(2), F.size(b)))
                ),
            ),
        )

    return F.when(F.size(numbers) == 0, F.array().cast("array<int>")).otherwise(let(numbers, by_block))


def matches(text: Column, pattern: str, needed: str = "") -> Column:
    """array<struct<start, end, value>> of a pattern's leftmost matches that do not overlap.

    ``text`` must be free of the marks (see ``unmarked``).
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def cut(marked: Column) -> Column:
        return let(F.split(marked, f"[{_OPEN}{_CLOSE}]", -1), located)

    def located(pieces: Column) -> Column:
        return let(
            running_sums(F.transform(pieces, F.length)),
            lambda ends: F.filter(
                F.transform(
                    pieces,
                    lambda v, i: F.struct(
                        (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value")
                    ),
                ),
                lambda _, i: i % 2 == 1,
            ),
        )

    found = let(
        F.regexp_replace(text, F.lit(pattern), F.lit(f"{_OPEN}$0{_CLOSE}")),
        lambda marked: F.when(F.contains(marked, F.lit(_OPEN)), cut(marked)).otherwise(none),
    )
    return F.when(F.contains(text, F.lit(needed)), found).otherwise(none) if needed else found


def unmarked(text: Column) -> Column:
    """The text with the marks replaced by a character that no pattern holds, and null as empty."""
    has = F.contains(text, F.lit(_OPEN)) | F.contains(text, F.lit(_CLOSE))
    return F.coalesce(F.when(has, F.translate(text, _OPEN + _CLOSE, _NEUTRAL * 2)).otherwise(text), F.lit(""))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d > "4", 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match is of its kind."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(14, 19) & _luhn(d))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of the four kinds by start, then kind.  ``text`` must be free of the marks."""
    def of_kind(k: int, kind: str) -> Column:
        found = F.filter(matches(text, PATTERNS[kind], NEEDED[kind]), lambda m: _holds(kind, m["value"]))
        return F.transform(
            found,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), m["value"].alias("value")
            ),
        )

    parts = [of_kind(k, kind) for k, kind in enumerate(KINDS[:4])]
    return F.sort_array(F.concat(*parts)).cast(_SPAN)


def _entity(span: Column) -> Column:
    """A value's identity: letter case, and separators of numbers, do not matter."""
    value = F.when(span["kind"].isin(2, 3), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.xxhash64(span["kind"], value)


def _terms_beside(text: Column, spans: Column) -> Column:
    """The whole words within REACH characters of each span, unless they overlap a span."""
    word = rf"\p{{L}}{{{SHORTEST},}}+"

    def window(span: Column) -> Column:
        # One character more on the outer side, or a blank for the text's border, shows whether a word is whole.
        before = F.when(
            span["start"] > REACH, F.substring(text, span["start"] - REACH, F.lit(REACH + 1))
        ).otherwise(F.concat(F.lit(" "), F.substring(text, F.lit(1), span["start"])))
        after = F.concat(F.substring(text, span["end"] + 1, F.lit(REACH + 1)), F.lit(" "))
        left = F.transform(
            matches(before, rf"(?<!^)(?<!\p{{L}}){word}(?!\p{{L}})"),
            lambda m: place(span, m, span["start"] - F.least(span["start"], F.lit(REACH)) - 1),
        )
        right = F.transform(
            matches(F.substring(after, 1, REACH + 1), rf"(?<!\p{{L}}){word}(?=[^\p{{L}}])"),
            lambda m: place(span, m, span["end"]),
        )
        return F.concat(left, right)

    def place(span: Column, m: Column, offset: Column) -> Column:
        return F.struct(
            _entity(span).alias("entity"),
            F.xxhash64(F.lower(m["value"])).alias("term"),
            (m["start"] + offset).alias("start"),
            (m["end"] + offset).alias("end"),
        )

    def free(t: Column) -> Column:
        return ~F.exists(spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))

    none = F.array().cast(_BESIDE)
    found = F.filter(F.flatten(F.transform(spans, window)), free)
    return F.when(F.size(spans) > 0, found).otherwise(none).cast(_BESIDE)


def _terms(text: Column) -> Column:
    """Hashes of a text's distinct terms: its words in lower case.  (Lower-casing the text first would cut some elsewhere.)"""
    words = F.regexp_extract_all(text, F.lit(rf"\p{{L}}{{{SHORTEST},}}+"), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(F.lower(w))))


def document_frequency(texts: Column, df: DataFrame) -> DataFrame:
    """For each term of all texts, in how many documents it stands: (term, n_t)."""
    return df.select(F.explode(_terms(texts)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))


@contextmanager
def _among(wanted: DataFrame) -> Iterator[Callable[[Column], Column]]:
    """A test of terms that holds for those of ``wanted`` and few others: FILTER_BITS bits, inside the block only."""
    spark, name = wanted.sparkSession, f"terms_{uuid.uuid4().hex}"

    def cell(term: Column) -> Column:
        return term.bitwiseAND(F.lit(FILTER_BITS - 1))

    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    cells = wanted.select(cell(F.col("term")).alias("cell"))
    words = cells.groupBy(F.shiftright("cell", 6).alias("i")).agg(F.bit_or(bit).alias("bits"))
    every = spark.range(FILTER_BITS // 64).withColumnRenamed("id", "i").join(words, "i", "left")
    ordered = F.sort_array(F.collect_list(F.struct("i", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    every.agg(F.transform(ordered, lambda x: x["bits"]).alias("bits")).createOrReplaceTempView(name)
    spark.sql(f"DECLARE VARIABLE {name} ARRAY<BIGINT>")
    try:
        spark.sql(f"SET VAR {name} = (SELECT bits FROM {name})")
        bits = F.expr(f"session.{name}")
        yield lambda term: F.call_function(
            "getbit", F.get(bits, F.shiftright(cell(term), 6).cast("int")), (cell(term) % 64).cast("int")
        ) == 1
    finally:
        spark.sql(f"DROP TEMPORARY VARIABLE {name}")
        spark.catalog.dropTempView(name)


def _disclosing(located: DataFrame, row: str, clean: Column, base: str) -> DataFrame:
    """(entity, term): the terms that disclose a value, among all values and terms that some text holds, near or far."""
    entities = F.array_distinct(F.transform(base, _entity))
    n = located.agg(F.count(F.lit(1)).cast("double")).scalar()
    ic = F.log(n / F.col("n_c"))

    def tells(n_ct: Column) -> Column:
        pmi = F.log(n * n_ct / (F.col("n_c") * F.col("n_t")))
        return (n_ct >= SUPPORT) & (ic > 0) & (pmi >= THRESHOLD * ic - 1e-9)

    # The counts are written, so that the joins are of plain tables, which can be split on a hot value, term or text.
    valued = located.where(F.size(base) > 0)
    holders = valued.select(F.explode(entities).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    holders = stage(holders.where(F.col("n_c") >= SUPPORT), "holders").frame
    frequency = stage(document_frequency(clean, located).where(F.col("n_t") >= SUPPORT), "frequency").frame
    values = stage(valued.select(row, F.explode(entities).alias("entity")).join(holders, "entity"), "values").frame
    terms = valued.select(row, F.explode(_terms(clean)).alias("term")).join(frequency, "term")
    both = terms.join(values, row).where(tells(F.least("n_c", "n_t")))  # no pair can share more documents
    counted = both.groupBy("entity", "term", "n_c", "n_t").agg(F.count(F.lit(1)).alias("n_ct"))
    return stage(counted.where(tells(F.col("n_ct"))).select("entity", "term"), "disclosing").frame


def _everywhere(located: DataFrame, terms: DataFrame, row: str, clean: Column, base: str) -> DataFrame:
    """(row, start, end): every place of the terms in all texts, unless it overlaps a span."""
    with _among(terms) as wanted:
        words = F.transform(
            matches(clean, rf"\p{{L}}{{{SHORTEST},}}+"),
            lambda m: F.struct(F.xxhash64(F.lower(m["value"])).alias("term"), m["start"].alias("start"), m["end"].alias("end")),
        )
        spans = F.col(base)
        free = F.filter(
            F.filter(words, lambda w: wanted(w["term"])),
            lambda w: ~F.exists(spans, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])),
        )
        words = located.where(F.exists(_terms(clean), wanted)).select(row, F.inline(free))
        return stage(words.join(terms.select("term"), "term", "left_semi").select(row, "start", "end"), "terms").frame


def find(
    df: DataFrame, text: str = "text", spans: str = "spans", keep: list[str] | None = None, everywhere: bool = False
) -> DataFrame:
    """``keep``'s columns (all) with the spans of each text: array<struct<start, kind, end, value>>, kind into KINDS.

    The texts and their base spans (and the terms beside them, if only these are marked) are written once below the shared
    folder; all else follows from that table.
    """
    columns = df.columns if keep is None else keep
    row, base, beside = (free_name(n, [*df.columns, "entity", "term", spans]) for n in ("row", "base", "beside"))
    clean = free_name("clean", [*df.columns, row, base, beside])
    source = df.select(*[F.col(f"`{c}`") for c in columns], unmarked(F.col(f"`{text}`").cast("string")).alias(clean))
    located = source.withColumn(row, F.monotonically_increasing_id()).withColumn(base, base_spans(F.col(clean)))
    if not everywhere:
        located = located.withColumn(beside, _terms_beside(F.col(clean), F.col(base)))
    again = text in columns
    located = stage(located.drop(clean) if again else located, "pii").frame
    cleaned = unmarked(F.col(f"`{text}`").cast("string")) if again else F.col(clean)

    disclosing = _disclosing(located, row, cleaned, base)
    if everywhere:
        marked = _everywhere(located, disclosing, row, cleaned, base)
    else:
        places = located.where(F.size(beside) > 0).select(row, F.inline(beside))
        marked = places.join(disclosing, ["entity", "term"], "left_semi")
    terms = marked.groupBy(row).agg(
        F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end", F.lit("").alias("value"))).alias("terms")
    )
    found = located.join(terms.withColumnRenamed(row, "its_row"), F.col(row) == F.col("its_row"), "left")
    all_spans = F.sort_array(F.concat(F.col(base), F.coalesce(F.col("terms").cast(_SPAN), F.array().cast(_SPAN))))
    return found.select(*[F.col(f"`{c}`") for c in columns], all_spans.alias(free_name(spans, columns)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def digest(df: DataFrame, keep: list[str], text: str = "text", everywhere: bool = False) -> DataFrame:
    """Counts, the base spans' digest and all spans of each text."""
    found = find(df, text, "spans_", keep, everywhere)
    spans = F.col("spans_")

    def number(k: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("bigint")

    kinds = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    base = F.sha2(listed(F.filter(spans, lambda s: s["kind"] < 4)).cast("binary"), 256)
    return found.select(*keep, *kinds, base.alias("base_sha256"), listed(spans).alias("spans"))


def sanitise(df: DataFrame, text: str = "text", everywhere: bool = False) -> DataFrame:
    """``df`` with each span of ``text`` generalised to its kind in brackets; overlapping spans become one."""
    spans = free_name("spans", df.columns)
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    column = F.col(f"`{text}`")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(column, acc["at"] + 1, s["start"] - acc["at"])
        more = F.concat(acc["out"], F.array(gap, F.get(labels, s["kind"])))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, more).otherwise(acc["out"]).alias("out")
        )

    def rest(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(column, acc["at"] + 1, F.length(column)))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rewritten = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(column)
    found = find(df, text, spans, everywhere=everywhere)
    return found.withColumn(text, rewritten).select(*[F.col(f"`{c}`") for c in df.columns])

"""Interleaving sources so that every prefix holds them in their target shares, by proportionate fairness.

Each source's rows are put in a pseudo-random order and cut into blocks.  A round offers each source as many slots as
its weight says.  Within a round of M blocks, block j of a source with m of them has the release time floor(j * M / m) and the
deadline ceil((j + 1) * M / m); at every slot the released block with the earliest deadline is taken.  So at every slot
each source is less than one block away from its exact share.  No row is dropped: a source that has run out leaves its
slots to the others, whose shares among themselves stay as their weights say.

A round's shape (how many blocks each source still brings) changes only where a source runs out: with k sources there
are at most 2k + 1 shapes, of as many slots as the weights' sum.  That table is the only thing that is scheduled step by
step, and the only thing broadcast; the slot of every other block follows from its number.  Ranks come from counts of hash
buckets, so a source with a third of all rows is spread over as many tasks as its rows need.

Only DataFrame functions are used.

Defined results: sources that the weights do not name, and null ones, form one further source together; rows with equal
keys are ordered by the hash of their source and otherwise interchangeable; other columns are kept, and a column of an
added one's name makes the added one's name longer by underscores.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

#: Hash buckets of each source, between which ranks are counted.
BUCKETS = 4096
#: Slots of a round, and slots times sources, at most: a round's schedule is worked out in one row, and is broadcast.
MOST_SLOTS, MOST_PLACES = 4_096, 1 << 18
#: Sources up to which the ranks' offsets are broadcast; with more they are joined by the partitioning that the ranks have.
FEW_SOURCES = 64


def mix(
    df: DataFrame,
    weights: Mapping[str, int],
    others: int = 1,
    block_rows: int = 16,
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """``df`` with its place in the mixture: ``block`` (of its source), ``slot`` (of the block) and ``position`` (of the row).

    ``weights``: slots in a round for each source, positive whole numbers; ``others``: for all remaining rows together.  They
    add up to MOST_SLOTS at most, and their sum times the number of sources to MOST_PLACES: finer weights are an error.
    Order by ``position`` to write the mixture.
    """
    if min([others, block_rows, *weights.values()]) < 1 or any(int(w) != w for w in weights.values()):
        raise ValueError("weights and block_rows are positive whole numbers")
    quota = [*weights.values(), others]
    if sum(quota) > MOST_SLOTS or sum(quota) * len(quota) > MOST_PLACES:
        raise ValueError(f"the weights add up to {sum(quota)} slots for {len(quota)} sources; use coarser ones")
    inner = ["stream", "hash", "bucket", "rank", "ahead", "sizes", "round", "turn", "shape", "shapes", "at", "ends"]
    names: dict[str, str] = {}
    for n in ["block", "slot", "position", *inner]:
        names[n] = free_name(n, [*df.columns, *names.values()])
    col = {n: F.col(f"`{c}`") for n, c in names.items()}

    named = F.array_position(F.array(*map(F.lit, weights)), F.col(f"`{source}`").cast("string")) if weights else F.lit(0)
    stream = F.coalesce(F.when(named > 0, named.cast("int") - 1), F.lit(len(weights)))
    hashed = F.xxhash64(F.col(f"`{key}`"), F.lit(1))
    keyed = df.withColumns(
        {
            names["stream"]: stream,
            names["hash"]: hashed,
            names["bucket"]: F.pmod(F.shiftright(hashed, 16), F.lit(BUCKETS)).cast("int"),
        }
    )

    # Ranks: rows of the source in earlier buckets, then the rank in the bucket.
    counts = keyed.groupBy(names["stream"], names["bucket"]).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(names["stream"]).orderBy(names["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        names["stream"], names["bucket"], F.coalesce(F.sum("n").over(before), F.lit(0)).alias(names["ahead"])
    )
    inside = Window.partitionBy(names["stream"], names["bucket"]).orderBy(
        names["hash"], F.col(f"`{key}`"), F.xxhash64(F.col(f"`{source}`"))
    )
    ranked = (
        keyed.withColumn(names["rank"], F.row_number().over(inside))
        .join(
            F.broadcast(offsets) if len(quota) <= FEW_SOURCES else offsets,  # BUCKETS rows for each source
            [names["stream"], names["bucket"]],
        )
        .withColumn(names["rank"], col["rank"] + col["ahead"] - 1)
    )

    sizes = _sizes(counts, names["stream"], len(quota))
    quotas = F.array(*map(F.lit, quota))
    table = _schedule(sizes, quotas, block_rows)
    placed = (
        ranked.withColumn(names["sizes"], sizes.scalar())
        .withColumn(names["block"], F.floor(col["rank"] / block_rows))
        .withColumn(names["round"], F.floor(col["block"] / F.get(quotas, col["stream"])))
        .withColumn(names["turn"], col["block"] % F.get(quotas, col["stream"]))
        .withColumn(names["shapes"], table.agg(F.sort_array(F.collect_set("shape"))).scalar())
        .withColumn(names["shape"], F.array_max(F.filter(col["shapes"], lambda s: s <= col["round"])))
    )
    lookup = table.select(
        F.col("shape").alias(names["shape"]),
        F.col("stream").alias(names["stream"]),
        F.col("turn").alias(names["turn"]),
        F.col("at").alias(names["at"]),
    )
    slotted = placed.join(F.broadcast(lookup), [names["shape"], names["stream"], names["turn"]]).withColumn(
        names["slot"], _slots_before(col["sizes"], quotas, col["round"], block_rows) + col["at"]
    )
    # Only a source's last block can be short: a row's position counts the rows missing from such blocks before it.
    short = slotted_ends(table, sizes, quotas, block_rows)
    missing = F.aggregate(
        F.filter(col["ends"], lambda e: e["slot"] < col["slot"]), F.lit(0).cast("bigint"), lambda a, e: a + e["missing"]
    )
    position = col["slot"] * block_rows + col["rank"] % block_rows - missing
    return (
        slotted.withColumn(names["ends"], short.scalar())
        .withColumn(names["position"], position)
        .select(*[F.col(f"`{c}`") for c in df.columns], col["block"], col["slot"], col["position"])
    )


def _sizes(counts: DataFrame, stream: str, k: int) -> DataFrame:
    """One row: the rows of each source."""
    total = counts.groupBy(F.col(stream).alias("s")).agg(F.sum("n").alias("n"))
    by_stream = total.agg(F.map_from_entries(F.collect_list(F.struct("s", "n"))).alias("m"))
    every = F.sequence(F.lit(0), F.lit(k - 1))
    return by_stream.select(
        F.transform(every, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("bigint"))).alias("sizes")
    )


def _blocks(sizes: Column, block_rows: int) -> Column:
    return F.transform(sizes, lambda n: F.ceil(n / block_rows))


def _slots_before(sizes: Column, quotas: Column, round_: Column, block_rows: int) -> Column:
    """Blocks of all sources in earlier rounds."""
    taken = F.zip_with(_blocks(sizes, block_rows), quotas, lambda b, q: F.least(b, round_ * q))
    return F.aggregate(taken, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _schedule(sizes: DataFrame, quotas: Column, block_rows: int) -> DataFrame:
    """(shape, stream, turn, at): the slot ``at`` of each block in a round; ``shape`` is the first round that looks so."""
    blocks = sizes.select(_blocks(F.col("sizes"), block_rows).alias("blocks"))
    changes = F.flatten(
        F.zip_with("blocks", quotas, lambda b, q: F.array(F.floor(b / q), F.floor(b / q) + 1))
    )
    shapes = blocks.select(
        "blocks", F.explode(F.array_distinct(F.concat(F.array(F.lit(0).cast("bigint")), changes))).alias("shape")
    )
    brought = F.zip_with("blocks", quotas, lambda b, q: F.greatest(F.lit(0), F.least(q, b - F.col("shape") * q)).cast("int"))
    rounds = shapes.select("shape", brought.alias("m")).select(
        "shape", "m", F.aggregate("m", F.lit(0), lambda a, x: a + x).alias("total")
    )

    total = F.col("total")

    def take(acc: Column, t: Column) -> Column:
        def offer(m: Column, s: Column) -> Column:
            j = F.get(acc["next"], s)
            released = (j < m) & (F.floor(j * total / m) <= t)
            return F.when(released, F.struct(F.ceil((j + 1) * total / m).alias("deadline"), s.alias("s")))

        first = F.array_min(F.filter(F.transform("m", offer), lambda o: o.isNotNull()))["s"]
        return F.struct(
            F.transform(acc["next"], lambda j, s: F.when(s == first, j + 1).otherwise(j)).alias("next"),
            F.concat(acc["out"], F.array(F.struct(first.alias("stream"), F.get(acc["next"], first).alias("turn")))).alias("out"),
        )

    start = F.struct(
        F.transform("m", lambda _: F.lit(0)).alias("next"), F.array().cast("array<struct<stream:int,turn:int>>").alias("out")
    )
    order = F.aggregate(F.sequence(F.lit(0), total - 1), start, take)["out"]
    return (
        rounds.where(total > 0)
        .select("shape", F.posexplode(order).alias("at", "b"))
        .select("shape", "b.stream", F.col("b.turn").cast("bigint").alias("turn"), "at")
    )


def slotted_ends(table: DataFrame, sizes: DataFrame, quotas: Column, block_rows: int) -> DataFrame:
    """One row: slot of each source's last block, and how many rows it is short of a whole one."""
    last = sizes.select("sizes", F.posexplode("sizes").alias("stream", "n")).where(F.col("n") > 0)
    last = last.withColumn("block", F.floor((F.col("n") - 1) / block_rows))
    q = F.get(quotas, F.col("stream"))
    last = last.select(
        "stream", "sizes", F.floor(F.col("block") / q).alias("round"), (F.col("block") % q).alias("turn"),
        ((F.col("block") + 1) * block_rows - F.col("n")).alias("missing"),
    )
    found = last.join(table, ["stream", "turn"]).where(F.col("shape") <= F.col("round"))
    at = F.max_by("at", "shape").alias("at")
    by_stream = found.groupBy("stream", "sizes", "round", "missing").agg(at)
    slot = _slots_before(F.col("sizes"), quotas, F.col("round"), block_rows) + F.col("at")
    return by_stream.agg(F.collect_list(F.struct(slot.alias("slot"), "missing")))

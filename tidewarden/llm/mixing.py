"""Mixing sources to target weights (DataFrame operations only).

The words of a source are laid end to end and packed into blocks of fixed length;
what is left at the end is one shorter block. The mix takes whole passes over a
source and, for the rest of its target, the first slots of one more pass. A slot
goes through a pseudorandom permutation of the source's block numbers
(swap-or-not: each round maps i to its partner k - i or leaves it, as a hash of
the larger of the two decides; a bijection on any range without tables or
sorting), and the block is joined by its number. The short block has the last
slot of a pass, and the last slot of the mix may take only the front of its block,
so every source gives its rounded target exactly.

Slots are dealt to output shards by hash. Given the totals, the counts of a source
over the shards are then multinomial with equal chances, the distribution of
independent draws for each shard conditioned on meeting the targets.

Positions of documents come from two running sums, over hashed chunks of a source
and inside a chunk, so that a source with a third of all rows is never one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, packed, settled, shuffle_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 128
CHUNKS = 1024
SLOTS_A_ROW = 4096
SHARDS = 64
ROUNDS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """source, source_size, source_no and target from one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes. A target stops at ``most`` times the source's size
    and the excess goes to the others by weight. With sources in the order of
    size by weight the stopped ones are a prefix, so running sums give the level
    that all others share. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, F.pmod("source_no", F.lit(len(weights))) + 1)
    )
    capped = named.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    total = F.sum("source_size").over(every) * F.lit(share)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    stopped = capped.withColumn("level", level).withColumn(
        "free", F.col("level") * F.col("weight") <= F.col("cap")
    )
    shared = F.min(F.when(F.col("free"), F.struct("source_no_rank", "level"))).over(every)["level"]
    return (
        stopped.withColumn("source_no_rank", F.row_number().over(order))
        .withColumn("shared", shared)
        .select(
            "source",
            "source_size",
            "source_no",
            F.least("cap", F.coalesce(F.col("shared") * F.col("weight"), F.col("cap"))).alias(
                "target"
            ),
        )
    )


def permuted(slot: Column, blocks: Column, seed: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom bijection of 0..blocks-1, by swap-or-not rounds."""

    def step(i: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(seed, r), blocks) + blocks - i, blocks)
        swap = F.xxhash64(seed, r, F.greatest(i, partner), F.lit(1)) % 2 == 0
        return F.when(swap, partner).otherwise(i)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), slot, step)


def _placed(rows: DataFrame, chunks: int) -> DataFrame:
    """source_no, target and start position of every row; ``row_key`` is unique."""
    in_source = ["source_no", "chunk"]
    sums = rows.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    sources = source_targets(sums.groupBy("source").agg(F.sum("chunk_size").alias("source_size")))
    before = Window.partitionBy("source_no").orderBy("chunk")
    bases = (
        sums.join(sources, sums["source"].eqNullSafe(sources["source"]))
        .select(sources["*"], "chunk", "chunk_size")
        .withColumn("base", F.sum("chunk_size").over(before) - F.col("chunk_size"))
        .drop("chunk_size")
    )
    inside = Window.partitionBy(*in_source).orderBy("doc_id", "size")
    joined = rows.join(
        bases.withColumnRenamed("source", "_s").withColumnRenamed("chunk", "_c"),
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("chunk") == F.col("_c")),
    ).drop("_s", "_c")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return joined.withColumns(
        {
            "start": F.col("base") + running - F.col("size"),
            "row_key": F.struct("source_no", "chunk", F.row_number().over(inside).alias("n")),
        }
    ).drop("base")


def mix_slots(
    sources: DataFrame,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 0,
    slots_a_row: int = SLOTS_A_ROW,
) -> DataFrame:
    """Slots of the mix: source_no, pass, slot, block, take (words) and shard.

    The slots of a source are cut into ranges before they are dealt out, so a
    large source is made by many tasks.
    """
    words = F.col("source_size")
    goal = F.round(F.col("target")).cast("long")
    ranges = (
        sources.where(words > 0)
        .withColumn("goal", goal)
        .withColumn("full", F.floor(words / F.lit(block_words)))
        .withColumn("blocks", F.ceil(words / F.lit(block_words)))
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.ceil(F.col("goal") / words).cast("int"))))
        .withColumn("left", F.least(F.col("goal") - F.col("pass") * words, words))
        .where("left > 0")
        .withColumn("slots", F.ceil(F.col("left") / F.lit(block_words)))
        .withColumn(
            "first",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(slots_a_row).cast("long"))),
        )
        .repartition(shuffle_count(sources.sparkSession), "source_no", "pass", "first")
    )
    last = F.least(F.col("first") + slots_a_row, F.col("slots")) - 1
    slots = ranges.withColumn("slot", F.explode(F.sequence("first", last)))
    draw = F.xxhash64(F.lit(seed), "source_no", "pass")
    block = F.when(F.col("slot") >= F.col("full"), F.col("slot")).otherwise(
        permuted(F.col("slot"), F.greatest("full", F.lit(1)), draw)
    )
    return slots.select(
        "source_no",
        "pass",
        "slot",
        block.alias("block"),
        F.least(F.lit(block_words), F.col("left") - F.col("slot") * block_words).alias("take"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "source_no", "pass", "slot"), F.lit(shards)).alias("shard"),
    )


def _pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """The part of each document in each block it overlaps."""
    end = F.col("start") + F.col("size")
    first = F.floor(F.col("start") / F.lit(block_words))
    last = F.floor((end - 1) / F.lit(block_words))
    return (
        placed.where("size > 0")
        .select("row_key", "source_no", "start", end.alias("end"), F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("low", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
        .withColumn("high", F.least(F.col("end") - F.col("block") * block_words, F.lit(block_words)))
        .select("row_key", "source_no", "block", "low", "high")
    )


def _sized(docs: DataFrame, columns: tuple[str, str, str], chunks: int) -> DataFrame:
    """One small row per document, written once: the texts are read a single time."""
    id_column, text_column, source_column = columns
    sized = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        n_words(F.col(text_column).cast("string")).alias("size"),
    ).withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    return settled(sized, "mix-sizes")


def _mix(sized: DataFrame, block_words: int, chunks: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Placed documents, and every slot with the words it takes of every document."""
    placed = _placed(sized, chunks)
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    # the planner sees the few ranges that slots are made from, not the slots: no broadcast
    slots = mix_slots(sources, block_words, shards, seed).hint("merge")
    joined = _pieces(placed, block_words).join(slots, ["source_no", "block"])
    taken = joined.where(F.col("low") < F.col("take")).withColumn("high", F.least("high", "take"))
    return placed, taken


def mix_blocks(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    block_words: int = BLOCK_WORDS,
    chunks: int = CHUNKS,
    shards: int = SHARDS,
    seed: int = 0,
) -> DataFrame:
    """The mix block by block: shard, source_no, pass, slot, and for every document in the
    block doc_id, first_word and end_word (positions in the document) and at (in the block)."""
    sized = _sized(docs, (id_column, text_column, source_column), chunks)
    placed, taken = _mix(sized, block_words, chunks, shards, seed)
    inside = F.col("block") * block_words - F.col("start")
    return taken.join(placed.select("row_key", "doc_id", "start"), "row_key").select(
        "shard",
        "source_no",
        "pass",
        "slot",
        "doc_id",
        (inside + F.col("low")).alias("first_word"),
        (inside + F.col("high")).alias("end_word"),
        F.col("low").alias("at"),
    )


def mixed_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    block_words: int = BLOCK_WORDS,
    chunks: int = CHUNKS,
    shards: int = SHARDS,
    seed: int = 0,
) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row.

    ``size`` counts words, 0 for null or empty texts, which are never taken. The
    null source is a source of its own, last in order. ``taken`` counts words with
    repeats and is at most twice ``size``; over a source it adds up to its target
    rounded to a whole number. Rows that repeat an id are separate rows; null ids
    come first. The result depends on the rows and ``seed`` only. An empty table
    gives an empty result. Other columns play no part.
    """
    sized = _sized(docs, (id_column, text_column, source_column), chunks)
    placed, taken = _mix(sized, block_words, chunks, shards, seed)
    words = taken.groupBy("row_key").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return placed.join(words, "row_key", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole and with their own columns.

    A document is written floor(taken / size) times, and once more with the chance
    of the remainder, which a hash of its id draws; rows of one id share the
    quotient over all of them. Documents without a word have no size to weigh and
    are written once.
    """
    shares = (
        mixed_words(docs, id_column, text_column, source_column, seed=seed)
        .groupBy("doc_id")
        .agg((F.sum("taken") / F.nullif(F.sum("size"), F.lit(0))).alias("times"))
        .withColumnRenamed("doc_id", "_id")
    )
    draw = F.pmod(F.xxhash64(F.lit(seed + 2), "_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor("times").cast("int")
    written = F.coalesce(whole + (draw < F.col("times") - whole).cast("int"), F.lit(1))
    rows = packed(docs, id_column, text_column).drop("text")
    return (
        rows.join(shares, F.col("doc_id").eqNullSafe(F.col("_id")))
        .select("row", F.explode(F.array_repeat(F.lit(0), written)).alias("_n"))
        .select("row.*")
    )

"""Exact dedup by a tree-merge of digest runs (DataFrame operations only).

Every row gets a run number from its id. A run is the set of (digest, best id,
count) entries of its rows. In each round the runs whose numbers agree but for
their lowest ``fan_bits`` bits are merged: one aggregation per round, 2**fan_bits
ways at once, so the partitions exchange runs as in a binomial tree and a digest
is never met by more than 2**fan_bits entries a round plus the map-side combine,
however many copies it has. On the way down the answer goes from the last run to
the entries of the first runs and from there to the rows; that join is on
(digest, run), which spreads the copies of one text over all runs.

Two texts count as equal when SHA-256, length in bytes and a second, independent
64-bit hash of the normalised text all agree; every merge checks all three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lowered, packed, settled

RUN_BITS = 8
FAN_BITS = 4
KEY = ["digest", "n_bytes", "check"]


def _with_digest(rows: DataFrame, run_bits: int) -> DataFrame:
    text = lowered(F.col("text"))
    return rows.withColumns(
        {
            "digest": F.unhex(F.sha2(text, 256)),
            "n_bytes": F.octet_length(text).cast("long"),
            "check": F.xxhash64(text),
            "run": F.pmod(F.xxhash64("doc_id"), F.lit(1 << run_bits)).cast("int"),
        }
    )


def _merged(rows: DataFrame, run_bits: int, fan_bits: int, keep: str) -> DataFrame:
    """One entry per digest and first run, with the id and size of the whole group."""
    best = F.max if keep == "largest" else F.min
    first = rows.groupBy(*KEY, "run").agg(
        best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    level = first
    for _ in range(-(-run_bits // fan_bits)):
        level = (
            level.withColumn("run", F.shiftright("run", fan_bits))
            .groupBy(*KEY, "run")
            .agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        )
    return first.select(*KEY, "run").join(level.drop("run"), KEY)


def _marked(rows: DataFrame, run_bits: int, fan_bits: int, keep: str) -> DataFrame:
    bare = rows.select(*KEY, "run", "doc_id")
    marked = rows.join(_merged(bare, run_bits, fan_bits, keep), [*KEY, "run"])
    same = Window.partitionBy(*KEY, "run", "doc_id").orderBy(F.lit(1))
    return marked.withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(same) == 1)
    )


def exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "largest",
    run_bits: int = RUN_BITS,
    fan_bits: int = FAN_BITS,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when identical after lower-casing A-Z; ``keep`` says whether
    the largest or the smallest id of a group stays. Null text counts as empty.
    Null ids lose to any id; a group of null ids only has a null ``keep_id`` and
    keeps one row. Of rows that repeat text and id exactly one is kept. An empty
    table gives an empty result. Columns besides id and text play no part.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    digests = settled(_with_digest(rows, run_bits).drop("text"), "exact-digests")  # texts are read once
    return _marked(digests, run_bits, fan_bits, keep).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "largest",
    run_bits: int = RUN_BITS,
    fan_bits: int = FAN_BITS,
) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_copies` keeps, with their own columns."""
    rows = _with_digest(packed(docs, id_column, text_column), run_bits).drop("text")
    return _marked(rows, run_bits, fan_bits, keep).where("kept").select("row.*")

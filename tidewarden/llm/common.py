"""Shared pieces of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_folder
from ..sources.files import remove

#: Fixed value: a word is a run of anything but space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Only these letters are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """The text with A-Z lower-cased and null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def packed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every input row as one struct ``row`` beside ``doc_id`` and ``text``.

    Names in the input cannot clash with working columns; ``row.*`` restores it.
    """
    return docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


#: The folders written in each :func:`scratch` that is open, the innermost last.
_written: ContextVar[tuple[list[str], ...]] = ContextVar("written", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what is settled inside once the block is over, but for what is settled with ``outlives``.

    Nothing lazy may leave the block that still reads a table of its own.
    """
    folders: list[str] = []
    token = _written.set((*_written.get(), folders))
    try:
        yield
    finally:
        _written.reset(token)
        for folder in folders:
            remove(spark, folder)


def settled(frame: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts the lineage: lost executors recompute from files that all share, and
    values such as generated row numbers stay what they were. With ``outlives`` the files stay
    when the innermost :func:`scratch` is over.
    """
    spark: SparkSession = frame.sparkSession
    folder = fresh_folder(spark, label)
    blocks = _written.get()[:-1] if outlives else _written.get()
    if blocks:
        blocks[-1].append(folder)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def numbered(frame: DataFrame, label: str) -> DataFrame:
    """The frame with a row number that is unique and, being written, stays."""
    return settled(frame.withColumn("row_no", F.monotonically_increasing_id()), label)


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

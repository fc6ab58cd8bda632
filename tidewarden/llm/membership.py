"""A bitmap of fixed size that tells which rows a later join can possibly need.

Texts are the widest column; rows that cannot match are better left out before they
are shuffled. The bitmap is built by a map-side combined aggregation and its size is a
constant, whatever the data. It only ever lets too many rows through: with more than
``MOST_KEYS`` keys it would let nearly all through and none is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytescan as B

BITS = 1 << 23
MOST_KEYS = BITS // 4


def _slot(keys: np.ndarray) -> np.ndarray:
    return B.mixed(keys.view(np.uint64)) & np.uint64(BITS - 1)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(BITS // 64, np.uint64)
    for batch in batches:
        keys = batch.column("k").drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        slot = _slot(keys)
        np.bitwise_or.at(table, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    at = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at].view(np.int64))], names=["word", "bits"])


class Bitmap:
    """Keys that may be present; ``table`` is None where every key may be."""

    def __init__(self, table: np.ndarray | None):
        self.table = table

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        if self.table is None:
            return np.ones(len(keys), bool)
        slot = _slot(np.ascontiguousarray(keys, np.int64))
        word = self.table[(slot >> np.uint64(6)).astype(np.int64)]
        return (word >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_of(rows: DataFrame, key: Column):
    """A broadcast bitmap of a 64-bit key of ``rows``; null keys are left out."""
    keys = rows.select(key.cast("long").alias("k"))
    table = None
    if keys.count() <= MOST_KEYS:
        words = keys.mapInArrow(_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        found = words.toArrow()
        table = np.zeros(BITS // 64, np.uint64)
        table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return rows.sparkSession.sparkContext.broadcast(Bitmap(table))


def held_rows(batches: Iterator[pa.RecordBatch], at: int, bitmap, wanted: bool = True) -> Iterator[pa.RecordBatch]:
    """The rows whose long column number ``at`` the bitmap may hold, or, not ``wanted``, the
    others; null keys are never held. For use inside a task."""
    for batch in batches:
        column = batch.column(at)
        held = bitmap.value.may_hold(column.fill_null(0).to_numpy(zero_copy_only=False))
        held &= column.is_valid().to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(held == wanted))


def possible(rows: DataFrame, key: str, bitmap, wanted: bool = True) -> DataFrame:
    """The rows that :func:`held_rows` picks by the column ``key``."""
    at = rows.columns.index(key)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return held_rows(batches, at, bitmap, wanted)

    return rows.mapInArrow(pick, rows.schema)

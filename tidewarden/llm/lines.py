"""Repeated lines: unit digests grouped over the whole corpus.

Units are the lines of a text. A unit is normalised (A-Z lower-cased, white space
runs as one space, ends trimmed) and counts if it has at least ``LEAST_WORDS`` words.
Units are ranked by document id, row and position. Equal units are grouped by a 128-bit
digest with map-side combining; the earliest ranked stays and all others are removed,
with their place in the original text kept. The first occurrence goes back to the
units by (digest, run), runs being a hash of the row, so a line that a third of all
documents share is dealt over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered

LEAST_WORDS = 5
RUNS = 256
DIGEST_BYTES = 16
SLICE_ROWS = 512

_UNITS = "array<struct<digest: binary, at: int, end: int>>"
_UNIT_TYPE = pa.list_(pa.struct([("digest", pa.binary()), ("at", pa.int32()), ("end", pa.int32())]))


def units(text: str | None, least_words: int = LEAST_WORDS) -> list[dict]:
    """Digest and place (characters, end exclusive, without the line feed) of every counting line."""
    found, at = [], 0
    for line in (text or "").split("\n"):
        words = line.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= least_words:
            digest = hashlib.blake2b(b" ".join(words), digest_size=DIGEST_BYTES).digest()
            found.append({"digest": digest, "at": at, "end": at + len(line)})
        at += len(line) + 1
    return found


def _list_units(least_words: int):
    def list_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(row, SLICE_ROWS)
                found = [units(t.as_py(), least_words) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _UNIT_TYPE)], names=["doc_id", "text", "units"])

    return list_units


def without(text: str | None, at: list[int], ends: list[int]) -> str:
    """The text without the lines at these places; a line goes with the line feed after it,
    or, at the end of the text, with the one before it."""
    text = text or ""
    parts, done = [], 0
    for start, end in zip(at, ends, strict=True):
        parts.append(text[done:start])
        done = end + 1
    parts.append(text[done:])
    kept = "".join(parts)
    return kept[:-1] if done > len(text) and kept.endswith("\n") else kept


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for row in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(row, SLICE_ROWS)
            texts, places = batch.column("text").to_pylist(), batch.column("removed").to_pylist()
            kept = [
                without(t, [p["at"] for p in r or []], [p["end"] for p in r or []])
                for t, r in zip(texts, places, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_units"), batch.column("removed"), pa.array(kept, pa.string())],
                names=["doc_id", "n_units", "removed", "text"],
            )


def repeated_units(rows: DataFrame) -> DataFrame:
    """row_no and the places of its units that occur earlier in the ranking.

    ``rows`` has row_no, doc_id and units. Null ids rank last.
    """
    unit = rows.select(
        "row_no", "doc_id", F.pmod(F.xxhash64("row_no"), F.lit(RUNS)).alias("run"), F.explode("units").alias("unit")
    ).select("row_no", "run", "doc_id", "unit.*")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_no", "at")
    runs = unit.groupBy("digest", "run").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = runs.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    first = runs.select("digest", "run").join(groups.select("digest", "first"), "digest")
    later = unit.join(first, ["digest", "run"]).where(
        (F.col("row_no") != F.col("first.row_no")) | (F.col("at") != F.col("first.at"))
    )
    # at most the lines of one document
    return later.groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct("at", "end"))).alias("removed"))


def drop_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """doc_id, n_units, n_removed, removed_chars, spans and text of every row.

    ``spans`` lists the removed lines as start:end in characters of the original text,
    comma-joined; ``text`` is what is left, null texts giving the empty text. Lines of
    fewer than ``least_words`` words are never removed. Repeated rows are rows of
    their own and of equal rank order a fixed one of them keeps the lines. Null ids rank
    last. An empty table gives an empty result. Other columns play no part.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    listed = numbered(
        rows.mapInArrow(_list_units(least_words), f"doc_id long, text string, units {_UNITS}"), "line-units"
    )
    removed = repeated_units(listed.select("row_no", "doc_id", "units"))
    joined = (
        listed.select("row_no", "doc_id", "text", F.size("units").cast("long").alias("n_units"))
        .join(removed, "row_no", "left")
        .select("doc_id", "text", "n_units", "removed")
    )
    cut = joined.mapInArrow(_cut, "doc_id long, n_units long, removed array<struct<at: int, end: int>>, text string")
    places = F.coalesce("removed", F.array().cast("array<struct<at: int, end: int>>"))
    lengths = F.aggregate(places, F.lit(0).cast("long"), lambda s, p: s + p["end"] - p["at"])
    spans = F.array_join(F.transform(places, lambda p: F.concat_ws(":", p["at"], p["end"])), ",")
    return cut.select(
        "doc_id",
        "n_units",
        F.size(places).cast("long").alias("n_removed"),
        lengths.alias("removed_chars"),
        spans.alias("spans"),
        "text",
    )

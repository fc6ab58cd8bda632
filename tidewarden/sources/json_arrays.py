"""Large JSON arrays read by many tasks.

A file is read as text that is cut behind closing braces; Spark splits such a file like any
other text, and a split goes on as chunks of bounded size. Whether a chunk begins inside a string, and how deep it is nested, depends on
all chunks before it. Each chunk is therefore summed up for both cases (it begins outside or inside a string), the sums of a split
are combined, and a prefix over the splits of a file tells where each one begins; these rows carry numbers only. An element of the array ends
with the brace that comes back to the array's own depth. Elements that lie within a chunk are cut out of it there; only
those across chunks are put together from their parts. No task holds more than some chunks or one element at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT_REQUEST
from ..session import written_once

#: A chunk gets no further pieces from this size on, in bytes.
CHUNK = 1 << 18

_SPLIT = ["file", "block"]
#: Texts travel compressed, so a batch of chunks is small on both sides.
_CODEC = "zstd"
_CHUNK = "file string, block long, nth long, size long, text binary, quotes long, outside long, inside long, opens int"
_OPENS = re.compile(rb"(?:[ \t\n\x0b\f\r]|\xef\xbb\xbf)*\[")
_SLASH, _QUOTE, _CLOSE = b'\\"}'
_NESTING = np.zeros(256, np.int8)
_NESTING[list(b"[{")] = 1
_NESTING[list(b"]}")] = -1


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, the parity of the quotation marks up to each and its change of depth if it is outside of strings."""
    content = np.frombuffer(text, np.uint8)
    plain = np.ones(len(content) + 1, bool)
    slashes = np.flatnonzero(content == _SLASH)
    if len(slashes):
        # of a run of backslashes every other one escapes what follows it
        place = np.arange(len(slashes))
        begun = np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) != 1, place, 0))
        plain[slashes[(place - begun) % 2 == 0] + 1] = False
    plain = plain[:-1]
    parity = np.cumsum((content == _QUOTE) & plain, dtype=np.int64) % 2
    return content, parity, np.where(plain, _NESTING[content], 0)


def _ends(text: bytes, inside: int, depth: int, base: int) -> np.ndarray:
    """The places behind the braces that end an element, in a chunk that begins in the given state."""
    content, parity, nesting = _marks(text)
    outside = parity == inside
    depths = depth + np.cumsum(np.where(outside, nesting, 0), dtype=np.int64)
    return np.flatnonzero((content == _CLOSE) & outside & (depths == base)) + 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """File, split, first row and end of the rows of one split."""
    if not batch.num_rows:
        return
    files, blocks = batch.column("file"), batch.column("block")
    other = np.ones(batch.num_rows, bool)
    other[1:] = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(other)
    for a, b in zip(at, np.append(at[1:], batch.num_rows), strict=True):
        yield files[int(a)].as_py(), blocks[int(a)].as_py(), int(a), int(b)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a split, as they come, joined to chunks, with what these do to the state."""
    split, nth, held, size = None, 0, [], 0

    def chunk() -> pa.RecordBatch:
        text = b"".join(held)
        _, parity, nesting = _marks(text)
        quotes, total, inside = int(parity[-1]), int(nesting.sum(dtype=np.int64)), int(nesting[parity == 1].sum(dtype=np.int64))
        opens = int(_OPENS.match(text) is not None)
        row = [split[0], split[1], nth, len(text), pa.compress(text, _CODEC, asbytes=True), quotes, total - inside, inside, opens]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        names = ["file", "block", "nth", "size", "text", "quotes", "outside", "inside", "opens"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    for batch in batches:
        pieces = batch.column("piece").cast(pa.large_binary())
        _, offsets, data = pieces.buffers()
        bounds = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        for file, block, row, end in _runs(batch):
            if split != (file, block):
                if held:
                    yield chunk()
                split, nth, held, size = (file, block), 0, [], 0
            while row < end:
                upto = min(end, max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK - size, "right")) - 1))
                held.append(data[int(bounds[row]) : int(bounds[upto])].to_pybytes())
                size, row = size + len(held[-1]), upto
                if size >= CHUNK or row < end:
                    yield chunk()
                    nth, held, size = nth + 1, [], 0
    if held:
        yield chunk()


def _states(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Row, text and ends of every chunk."""
    texts, sizes = batch.column("text"), batch.column("size")
    columns = (batch.column(c).to_pylist() for c in ("begins_inside", "depth", "base"))
    for row, state in enumerate(zip(*columns, strict=True)):
        text = pa.decompress(texts[row].as_buffer(), sizes[row].as_py(), _CODEC, asbytes=True)
        yield row, text, _ends(text, *state)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of ends in a chunk, what stands up to the first and what stands behind the last."""
    for batch in batches:
        counts, heads, rests = [], [], []
        for _, text, ends in _states(batch):
            counts.append(len(ends))
            heads.append(text[: ends[0]] if len(ends) else text)
            rests.append(text[ends[-1] :] if len(ends) else b"")
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("chunk", "file", "block", "nth")),
                pa.array(counts, pa.int64()), pa.array(heads, pa.binary()), pa.array(rests, pa.binary()),
            ],
            names=["chunk", "file", "block", "nth", "ends", "head", "rest"],
        )


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements that begin behind an end in a chunk and end in it."""
    for batch in batches:
        files, firsts = batch.column("file"), batch.column("earlier").to_pylist()
        for row, text, ends in _states(batch):
            n = len(ends) - 1
            if n > 0:
                texts = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])
                numbers = pa.array(firsts[row] + 1 + np.arange(n, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.repeat(files[row], n), numbers, texts], names=["file", "element", "text"])


def _before(column: Column | str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """file, element (its number in the file, from 0) and ``body``, the JSON text, of every object in the arrays.

    A file holds one array of objects, or a single object. Elements that are no objects are left out, so is
    what follows the array. Blank files have no elements; of a file that was cut off the last element may be broken.
    """
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.concat("value", F.lit("}")).alias("piece"),
    )
    numbered = raw.mapInArrow(_chunks, _CHUNK).withColumn("chunk", F.monotonically_increasing_id())
    chunks = written_once(numbered, "array-chunks")
    within = Window.partitionBy(*_SPLIT).orderBy("nth")
    # inside a split: parity so far, then the depth so far for both ways to begin it
    parity = chunks.drop("text", "size").withColumn("parity", _before("quotes", within) % 2)
    if_out = F.when(F.col("parity") == 0, F.col("outside")).otherwise(F.col("inside"))
    if_in = F.when(F.col("parity") == 0, F.col("inside")).otherwise(F.col("outside"))
    stepped = parity.withColumns({"if_out": if_out, "if_in": if_in})
    splits = stepped.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("quotes"), F.sum("if_out").alias("out_total"), F.sum("if_in").alias("in_total"),
        F.min_by("opens", "nth").alias("opens"),
    )
    along = Window.partitionBy("file").orderBy("block")
    begun = splits.withColumn("split_inside", _before("quotes", along) % 2)
    change = F.when(F.col("split_inside") == 0, F.col("out_total")).otherwise(F.col("in_total"))
    # a file that begins with a bracket has its elements one level down
    base = F.first("opens").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = begun.withColumn("change", change).select(
        *_SPLIT, "split_inside", _before("change", along).alias("depth_before"), base.alias("base")
    )
    delta = F.when(F.col("split_inside") == 0, F.col("if_out")).otherwise(F.col("if_in"))
    placed = stepped.join(starts, _SPLIT).withColumn("delta", delta).select(
        "chunk", ((F.col("split_inside") + F.col("parity")) % 2).alias("begins_inside"),
        (F.col("depth_before") + _before("delta", within)).alias("depth"), "base",
    )
    states = written_once(placed, "array-states")
    known = chunks.select("chunk", *_SPLIT, "nth", "size", "text").join(F.broadcast(states), "chunk")  # numbers, one row per chunk
    edges = written_once(
        known.mapInArrow(_edges, "chunk long, file string, block long, nth long, ends long, head binary, rest binary"), "array-edges"
    )
    in_split = edges.select("chunk", *_SPLIT, "nth", "ends").withColumn("nth_end", _before("ends", within))
    of_split = in_split.groupBy(*_SPLIT).agg(F.sum("ends").alias("ends")).select(*_SPLIT, _before("ends", along).alias("ends_before"))
    firsts = in_split.join(of_split, _SPLIT).select("chunk", (F.col("ends_before") + F.col("nth_end")).alias("earlier"))
    firsts = written_once(firsts, "array-firsts")
    whole = known.join(F.broadcast(firsts), "chunk").mapInArrow(_whole, "file string, element long, text string")
    entry = lambda behind, text, closed: F.struct(
        (F.col("earlier") + behind).alias("element"), F.col(text).cast("string").alias("text"), closed.cast("int").alias("closed")
    )
    sides = F.array(entry(F.lit(0), "head", F.col("ends") > 0), entry(F.col("ends"), "rest", F.lit(False)))
    parts = edges.join(firsts, "chunk").select("file", "block", "nth", F.explode(sides).alias("side")).select(
        "file", "side.element", "side.closed", F.struct("block", "nth", "side.text").alias("part")
    ).where(F.col("part.text") != "")
    joined = parts.groupBy("file", "element").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.max("closed").alias("closed"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    found = whole.unionByName(joined.where("closed = 1").select("file", "element", text.alias("text")))
    # what stands before an element: the bracket, commas, blanks and elements that are no objects
    return found.select("file", "element", F.regexp_replace("text", r'^(?:[^"{]|"(?:\\.|[^"\\])*")*', "").alias("body"))


def read_large_arrays(spark: SparkSession, path: str, schema: T.StructType = EVENT_REQUEST) -> DataFrame:
    """The rows of ``requests.read_request_arrays``, with the elements of one file read by many tasks."""
    return array_elements(spark, path).select(F.from_json("body", schema).alias("item")).select("item.*")

"""Repeated substrings of whole texts, by a distributed suffix sort and an exact check.

1. Texts get anchors: the places of the smallest hashes of every ``WINDOW`` positions (winnowing). A string of
   ``LENGTH`` bytes, a window, belongs to the anchor of its first ``WINDOW`` positions, so equal windows
   belong to anchors at the same distance from their starts, and every window belongs to one anchor. The ``CORE`` bytes from an
   anchor on lie in all its windows. Equal texts are one text with a number of copies.
2. An anchor whose core occurs once has no repeated window. What is left are strings of cores that occur
   elsewhere; :mod:`suffixes` sorts their suffixes.
3. Adjacent suffixes are compared core by core. Where they agree for ``LENGTH`` bytes
   or more, every window in that stretch is repeated.
4. That leaves the ends of such stretches, and other places with their cores. Anchors that are equal in all bytes that their windows
   cover are one class; all windows of a class of two or more are repeated. Windows are
   compared one by one only where a core has several classes.

Cores, classes, windows and texts are compared by 64-bit hashes and, for whole texts, SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytescan as B
from .common import numbered, scratch, settled
from .membership import bitmap_of, possible
from .ordering import repeated_rows
from .suffixes import suffix_ranks

LENGTH = 400
GRAM = 16
WINDOW = 160
CORE = LENGTH - WINDOW + 1
REACH = LENGTH + WINDOW
DEPTH = 9
#: Texts are looked at in slices of so many bytes, whose hashes stay in a core's cache.
SLICE = 1 << 16
#: Spans are hashed in so many bytes at a time.
SEGMENT = 1 << 20
#: Entries handed on at once.
ROWS = 200_000
_MASKS = ["m0", "m1", "m2"]
_ANCHOR = "sid long, at int, core long, held long, far short, near short"


def owners_of(content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors, the row of each, and the first and the last of the places that it is the smallest of."""
    n = len(content) - GRAM + 1
    if n < WINDOW:
        return (np.zeros(0, np.int64),) * 4
    raw = np.ascontiguousarray(content)
    low = np.ndarray((n,), "<u8", raw, 0, (1,))
    high = np.ndarray((n,), "<u8", raw, 8, (1,))
    h = (low * B.MULTIPLIER) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h >>= np.uint64(32)
    key = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    least, width = key, 1
    while width * 2 <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[: n - WINDOW + 1], least[WINDOW - width :])
    # of equal hashes the last one counts, so the places of one anchor follow each other
    owner = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    places = np.maximum(np.diff(bounds) - (WINDOW + GRAM - 2), 0)
    firsts = np.cumsum(places) - places
    start = np.arange(firsts[-1] + places[-1]) + np.repeat(bounds[:-1] - firsts, places)
    owner, row = owner[start], np.repeat(np.arange(len(places)), places)
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return owner[at], row[at], start[at], start[np.append(at[1:], len(owner)) - 1]


def cuts_of(content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of the rows and the row of each."""
    return owners_of(content, bounds)[:2]


def _hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` of short spans, whose starts rise, with tables for a segment only."""
    if len(content) <= SEGMENT:
        return B.span_hashes(content, starts, ends)
    out = np.zeros(len(starts), np.uint64)
    for low in range(0, len(content), SEGMENT):
        a, b = np.searchsorted(starts, (low, low + SEGMENT))
        if a < b:
            out[a:b] = B.span_hashes(content[low : ends[a:b].max()], starts[a:b] - low, ends[a:b] - low)
    return out


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its anchors: place, hashes of the core and of all their windows' bytes, distance to the first and the last window."""
    for batch in batches:
        for row, content, bounds in B.slices(batch.column("text"), SLICE):
            at, rows, first, last = owners_of(content, bounds)
            last = np.minimum(last, bounds[rows + 1] - LENGTH)
            some = first <= last
            at, rows, first, last = at[some], rows[some], first[some], last[some]
            core = _hashes(content, at, at + CORE).view(np.int64)
            core[core == 0] = 1
            far, near = (at - first).astype(np.uint64), (at - last).astype(np.uint64)
            held = B.mixed(_hashes(content, first, last + LENGTH) ^ (far * np.uint64(WINDOW) + near + np.uint64(1)) * B.MULTIPLIER)
            n = len(bounds) - 1
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n)))).astype(np.int32))
            part = batch.slice(row, n)
            lists = ((at - bounds[rows]).astype(np.int32), core, held.view(np.int64), far.astype(np.int16), near.astype(np.int16))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("tid"),
                    pa.array(np.diff(bounds)),
                    *(pa.ListArray.from_arrays(ends, pa.array(values)) for values in lists),
                ],
                names=["doc_id", "tid", "n_bytes", "starts", "cores", "helds", "fars", "nears"],
            )


def _distinct_texts(rows: DataFrame) -> DataFrame:
    """sid, tid, copies, one document, n_bytes and anchors of every distinct long text."""
    lists = ["starts", "cores", "helds", "fars", "nears"]
    found = rows.mapInArrow(
        _anchors,
        "doc_id long, tid binary, n_bytes long, starts array<int>, cores array<long>, helds array<long>, fars array<short>, nears array<short>",
    )
    texts = (
        found.where(F.col("n_bytes") >= LENGTH)
        .groupBy("tid")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("doc_id").alias("one"),
            F.first("n_bytes").alias("n_bytes"),
            *[F.first(c).alias(c) for c in lists],
        )
    )
    return numbered(texts, "substring-texts").withColumnRenamed("row_no", "sid")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per anchor."""
    for batch in batches:
        lists = [batch.column(c) for c in ("starts", "cores", "helds", "fars", "nears")]
        sids = np.repeat(batch.column("sid").to_numpy(), np.diff(lists[0].offsets.to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array(sids), *(c.flatten() for c in lists)], names=["sid", "at", "core", "held", "far", "near"])


def _strings(texts: DataFrame, often: DataFrame) -> DataFrame:
    """sid, starts, distances and symbols: the cores that occur elsewhere, 0 for the others."""

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = []
            for starts, cores, ats in zip(*(batch.column(c) for c in ("starts", "cores", "ats")), strict=True):
                kept = np.zeros(len(cores.values), np.int64)
                ks = np.searchsorted(starts.values.to_numpy(), ats.values.to_numpy())
                kept[ks] = cores.values.to_numpy()[ks]
                symbols.append(kept)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("sid", "starts", "fars", "nears")), pa.array(symbols, pa.list_(pa.int64()))],
                names=["sid", "starts", "fars", "nears", "symbols"],
            )

    kept = often.groupBy("sid").agg(F.collect_list("at").alias("ats"))
    joined = texts.select("sid", "starts", "cores", "fars", "nears").join(kept, "sid")
    return settled(
        joined.mapInArrow(mask, "sid long, starts array<int>, fars array<short>, nears array<short>, symbols array<long>"),
        "substring-strings",
    )


def _joined(parts: Iterator[dict[str, np.ndarray]], size: str) -> Iterator[dict[str, np.ndarray]]:
    """The parts put together until the column ``size`` has ``ROWS`` entries."""
    held: list[dict[str, np.ndarray]] = []
    for part in parts:
        held.append(part)
        if sum(len(h[size]) for h in held) >= ROWS:
            yield {k: np.concatenate([h[k] for h in held]) for k in part}
            held = []
    if held:
        yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}


def _runs_of_cores(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    columns = (batch.column(c) for c in ("starts", "fars", "nears", "symbols"))
    for sid, *lists in zip(batch.column("sid").to_pylist(), *columns, strict=True):
        at, fars, nears, s = (x.values.to_numpy(zero_copy_only=False) for x in lists)
        every = np.flatnonzero(s)
        gaps = np.append(np.flatnonzero(s == 0), len(s))
        stops = gaps[np.searchsorted(gaps, every)]
        stops = np.minimum(stops, np.maximum(np.searchsorted(at, at[every] + REACH), every + 1))
        for low in range(0, len(every), ROWS // 10):
            js, stop = every[low : low + ROWS // 10], stops[low : low + ROWS // 10]
            counts = stop - js
            flat = np.arange(counts.sum()) + np.repeat(js - np.cumsum(counts) + counts, counts)
            yield {
                "sid": np.full(len(js), sid), "j": js.astype(np.int64), "start": at[js].astype(np.int32), "far": fars[js], "near": nears[js],
                "counts": counts, "prefix": s[flat], "spans": (at[flat] - np.repeat(at[js], counts) + CORE).astype(np.int32),
            }


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per anchor the cores from it on, until REACH bytes or a gap, and the bytes they span."""
    plain = ["sid", "j", "start", "far", "near"]
    for batch in batches:
        for part in _joined(_runs_of_cores(batch), "prefix"):
            ends = pa.array(np.append(0, np.cumsum(part["counts"])).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(part[c])) for c in ("prefix", "spans")]
            yield pa.RecordBatch.from_arrays([*(pa.array(part[c]) for c in plain), *lists], names=[*plain, "prefix", "spans"])


def _padded(column: pa.Array, kind: type) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(1, int(lengths.max(initial=1)))), kind)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per suffix the bytes in which it agrees with the one before or after it.

    A partition's first row is not compared with the partition before; what that
    misses is left to the check of windows.
    """
    held = None
    for batch in batches:
        batch = pa.concat_batches([held, batch]) if held is not None else batch
        if batch.num_rows < 2:
            held = batch
            continue
        agree = _agreeing(batch)
        # the last row waits for the next one; the first of a later batch was emitted before
        yield _measured(batch, agree, 0, batch.num_rows - 1, held is not None)
        held = batch.slice(batch.num_rows - 2)
    if held is not None:
        agree = _agreeing(held)
        yield _measured(held, agree, held.num_rows - 1, held.num_rows, False)


def _agreeing(batch: pa.RecordBatch) -> np.ndarray:
    symbols, spans = _padded(batch.column("prefix"), np.int64), _padded(batch.column("spans"), np.int64)
    agree = np.zeros(batch.num_rows + 1, np.int64)
    equal = (symbols[1:] == symbols[:-1]) & (symbols[1:] != 0)
    count = np.cumprod(equal, axis=1).sum(axis=1)
    agree[1:-1] = np.where(count > 0, spans[np.arange(1, len(spans)), np.maximum(count - 1, 0)], 0)
    return agree


def _measured(batch: pa.RecordBatch, agree: np.ndarray, start: int, end: int, skip: bool) -> pa.RecordBatch:
    start = start + 1 if skip else start
    best = np.maximum(agree[:-1], agree[1:])[start:end]
    part = batch.slice(start, end - start)
    first = part.column("prefix")
    symbol = first.flatten().to_numpy(zero_copy_only=False)[first.offsets.to_numpy()[:-1] - first.offsets.to_numpy()[0]]
    return pa.RecordBatch.from_arrays(
        [*(part.column(c) for c in ("sid", "start", "far", "near")), pa.array(symbol), pa.array(best.astype(np.int32))],
        names=["sid", "start", "far", "near", "core", "agree"],
    )


def _united(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint, ordered unions of ranges (end exclusive); touching ranges join."""
    if not len(lows):
        return lows, highs
    order = np.argsort(lows, kind="stable")
    lows, tops = lows[order], np.maximum.accumulate(highs[order])
    new = np.ones(len(lows), bool)
    new[1:] = lows[1:] > tops[:-1]
    at = np.flatnonzero(new)
    return lows[at], tops[np.append(at[1:] - 1, len(lows) - 1)]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the ranges of starts known to be repeated, and the cores of anchors with windows outside of them."""
    for batch in batches:
        sure, unsure = [], []
        for found in batch.column("found"):
            rows = found.values
            names = ("start", "far", "near", "core", "agree")
            start, far, near, core, agree = (rows.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names)
            long = agree >= LENGTH
            low, high = _united(start[long], start[long] + agree[long] - LENGTH + 1)
            k = np.searchsorted(low, start - far, "right") - 1
            inside = (k >= 0) & (high[np.maximum(k, 0)] > start - near) if len(low) else np.zeros(len(start), bool)
            sure.append([{"low": int(a), "high": int(b)} for a, b in zip(low, high, strict=True)])
            unsure.append(np.unique(core[~inside]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("sid"),
                pa.array(sure, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
                pa.array(unsure, pa.list_(pa.int64())),
            ],
            names=["sid", "sure", "unsure"],
        )


def _hashed(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    for text, anchors in zip(batch.column("text"), batch.column("anchors"), strict=True):
        content = np.frombuffer(text.as_buffer(), np.uint8)
        rows = anchors.values
        at, far, near, held, n = (rows.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "far", "near", "held", "n"))
        for low in range(0, len(at), ROWS // WINDOW):
            some = slice(low, low + ROWS // WINDOW)
            counts = far[some] - near[some] + 1
            back = np.repeat(far[some] + np.cumsum(counts) - counts, counts) - np.arange(counts.sum())
            begin = np.repeat(at[some], counts) - back
            yield {
                "held": np.repeat(held[some], counts), "n": np.repeat(n[some], counts), "back": back.astype(np.int32),
                "window": _hashes(content, begin, begin + LENGTH).view(np.int64),
            }


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every window of the anchors, which come in order."""
    for batch in batches:
        for part in _joined(_hashed(batch), "window"):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in part.values()], names=list(part))


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose text may be one of ``wanted`` (a column ``tid``); no others are shuffled."""
    keyed = rows.select("doc_id", "tid", "text", F.xxhash64("tid").alias("_key"))
    return possible(keyed, "_key", bitmap_of(wanted, F.xxhash64("tid"))).drop("_key")


def _repeated_anchors(rows: DataFrame, texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """sid and per anchor the masks of its distances at which windows are repeated, -1 in all for each of them.

    ``anchors`` are all that share a core with any anchor in question.
    """
    sized = anchors.groupBy("core", "held").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("sid", "at", "far", "near")).alias("one"))
    classes = settled(sized.select("core", "held", "n", "one.*"), "substring-classes")
    unlike = repeated_rows(classes, ["core"], F.col("held")).groupBy("sid")
    looked_up = unlike.agg(F.array_sort(F.collect_list(F.struct("at", "far", "near", "held", "n"))).alias("anchors"))
    places = settled(looked_up.join(texts.select("sid", "tid", F.col("one").alias("_one")), "sid"), "substring-places")
    fine = (
        _texts_of(rows, places)
        .join(places, "tid")
        .where(F.col("doc_id").eqNullSafe(F.col("_one")))
        .select("text", "anchors")
        .mapInArrow(_windows, "held long, n long, back int, window long")
    )
    often = repeated_rows(settled(fine, "substring-windows"), ["window"], F.col("held"), F.col("n"))
    bits = [F.expr(f"CASE WHEN back DIV 64 = {i} THEN shiftleft(1L, back % 64) ELSE 0L END") for i in range(3)]
    some = often.groupBy("held").agg(*[F.bit_or(bit).alias(m) for bit, m in zip(bits, _MASKS, strict=True)])
    every = classes.where("n > 1").select("held", *[F.lit(-1).cast("long").alias(m) for m in _MASKS])
    masks = settled(some.union(every).groupBy("held").agg(*[F.bit_or(m).alias(m) for m in _MASKS]), "substring-masks")
    return anchors.select("sid", "at", "far", "near", "held").join(masks, "held").drop("held")


def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed byte ranges of a text from its repeated starts."""
    for batch in batches:
        out = []
        plain = (batch.column(c).to_pylist() for c in ("n_bytes", "copies"))
        for n_bytes, copies, sure, edges in zip(*plain, batch.column("sure"), batch.column("edges"), strict=True):
            if copies > 1:
                out.append([{"low": 0, "high": n_bytes}])
                continue
            lows, highs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            if sure.is_valid:
                lows.append(sure.values.field("low").to_numpy().astype(np.int64))
                highs.append(sure.values.field("high").to_numpy().astype(np.int64))
            if edges.is_valid:
                rows = edges.values
                at, far, near = (rows.field(c).to_numpy().astype(np.int64) for c in ("at", "far", "near"))
                masks = np.stack([rows.field(m).to_numpy() for m in _MASKS], axis=1)
                every = (masks == -1).all(axis=1)
                lows.append(at[every] - far[every])
                highs.append(at[every] - near[every] + 1)
                bits = np.unpackbits(np.ascontiguousarray(masks[~every]).view(np.uint8), axis=1, bitorder="little")
                row, back = np.nonzero(bits)
                lows.append(at[~every][row] - back)
                highs.append(lows[-1] + 1)
            a, b = _united(np.concatenate(lows), np.concatenate(highs) + LENGTH - 1)
            out.append([{"low": int(x), "high": int(y)} for x, y in zip(a, b, strict=True)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("tid"), pa.array(out, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))],
            names=["tid", "removed"],
        )


def _agreed(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The distinct texts without their anchors, the anchors whose core is repeated, and the bytes in which each of them agrees with a neighbour."""
    with scratch(rows.sparkSession):
        whole = _distinct_texts(rows)
        texts = settled(whole.select("sid", "tid", "copies", "one", "n_bytes"), "substring-known", outlives=True)
        listed = whole.select("sid", "starts", "cores", "helds", "fars", "nears").mapInArrow(_listed, _ANCHOR)
        often = settled(repeated_rows(listed, ["core"], F.col("sid")), "substring-often", outlives=True)
        strings = _strings(whole, often)
        ranks = suffix_ranks(strings, DEPTH)
        prefixes = strings.mapInArrow(
            _prefixes, "sid long, j long, start int, far short, near short, prefix array<long>, spans array<int>"
        )
        ordered = prefixes.join(ranks, ["sid", "j"]).orderBy("rank", "sid", "j").select("sid", "start", "far", "near", "prefix", "spans")
        agreed = ordered.mapInArrow(_agreement, "sid long, start int, far short, near short, core long, agree int")
        return texts, often, settled(agreed, "substring-agreed", outlives=True)


def removed_ranges(rows: DataFrame) -> DataFrame:
    """tid and the removed byte ranges of every distinct text that loses any; ``rows`` has
    doc_id, text (not null) and tid."""
    with scratch(rows.sparkSession):
        texts, often, agreed = _agreed(rows)
        found = agreed.groupBy("sid").agg(F.collect_list(F.struct("start", "far", "near", "core", "agree")).alias("found"))
        stretches = settled(
            found.mapInArrow(_stretches, "sid long, sure array<struct<low: int, high: int>>, unsure array<long>"),
            "substring-stretches",
        )
        # written, as a join with a plain table can be split where one core has many anchors
        ends = settled(stretches.select(F.explode("unsure").alias("core")).distinct(), "substring-ends")
        repeated = _repeated_anchors(rows, texts, often.join(ends, "core"))
        edges = repeated.groupBy("sid").agg(F.collect_list(F.struct("at", "far", "near", *_MASKS)).alias("edges"))
        marked = (
            texts.select("sid", "tid", "n_bytes", "copies")
            .join(stretches.select("sid", "sure"), "sid", "left")
            .join(edges, "sid", "left")
            .where("copies > 1 OR size(sure) > 0 OR edges IS NOT NULL")
        )
        removed = marked.select("tid", "n_bytes", "copies", "sure", "edges").mapInArrow(
            _removals, "tid binary, removed array<struct<low: long, high: long>>"
        )
        return settled(removed, "substring-removed", outlives=True).where("size(removed) > 0")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests = [], []
        for text, removed in zip(batch.column("text"), batch.column("removed").to_pylist(), strict=True):
            raw = text.as_py().encode("utf-8")
            keep, done, gone = hashlib.sha256(), 0, 0
            for r in removed or []:
                keep.update(raw[done : r["low"]])
                done, gone = r["high"], gone + r["high"] - r["low"]
            keep.update(raw[done:])
            counts.append((len(raw), gone, len(removed or [])))
            digests.append(keep.hexdigest())
        n_bytes, n_removed, n_spans = zip(*counts, strict=True) if counts else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_bytes, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def drop_repeated_substrings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere
    else, in the same text or another row's; overlaps count, and strings are judged on the
    input. Matches never cross rows. Null texts are empty; texts shorter than ``LENGTH`` bytes
    lose nothing, equal longer texts everything, repeated rows included. Null
    ids are ordinary rows. An empty table gives an empty result. Other columns play no part.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).withColumn("tid", F.unhex(F.sha2("text", 256)))
    removed = removed_ranges(rows)
    # a text that loses nothing keeps its length and its hash
    measured = rows.select("doc_id", "tid", F.octet_length("text").cast("long").alias("n_bytes"))
    whole = measured.join(removed.select("tid"), "tid", "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.lower(F.hex("tid")).alias("kept_sha256"),
    )
    cut = _texts_of(rows, removed).join(removed, "tid").select("doc_id", "text", "removed")
    kept = cut.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return whole.unionByName(kept)

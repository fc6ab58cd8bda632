"""Vectorised scans over the UTF-8 bytes of Arrow text columns, inside tasks.

Texts are looked at in slices of a few megabytes (a longer text is a slice of its
own), so memory is bounded by a slice or the longest text, not by a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
#: Longer tables of powers are not kept for the next call.
KEPT_POWERS = 1 << 16

#: The bytes that separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Lower-cases A-Z and nothing else.
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_powers: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * MULTIPLIER
    return h ^ (h >> np.uint64(32))


def _powers_of(n: int) -> np.ndarray:
    table = np.full(n + 1, _STEP, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and their inverses, n + 1 each."""
    if len(_powers.get("up", ())) <= n:
        size = 1 << max(16, int(n).bit_length())
        inverse = pow(_STEP, -1, 1 << 64)
        for name, base in (("up", _STEP), ("down", inverse)):
            table = np.full(size + 1, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    bounds = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content, bounds


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets (from 0) of consecutive groups of rows."""
    content, bounds = utf8(column)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1)
        end = min(end, len(column))
        yield row, content[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def word_bounds(content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    if not len(content):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[content]
    cut = np.zeros(len(content) + 1, bool)
    cut[bounds] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def span_hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over the bytes."""
    up, down = powers(len(content))
    total = np.zeros(len(content) + 1, np.uint64)
    np.cumsum((content.astype(np.uint64) + np.uint64(1)) * up[: len(content)], out=total[1:])
    raw = (total[ends] - total[starts]) * down[starts]
    return mixed(raw ^ ((ends - starts).astype(np.uint64) * MULTIPLIER))


def word_hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of :func:`span_hashes` for rising spans that do not overlap and are not empty.

    The powers start anew with every span, so their table is as long as the longest one.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    within = np.arange(firsts[-1] + lengths[-1]) - np.repeat(firsts, lengths)
    longest = int(lengths.max())
    up = powers(longest)[0] if longest <= KEPT_POWERS else _powers_of(longest)
    values = (content[within + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)) * up[within]
    return mixed(np.add.reduceat(values, firsts) ^ (lengths.astype(np.uint64) * MULTIPLIER))


def windows_of(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words within one row, in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x2545F4914F6CDD1D) + hashes[k : k + n]
    whole = rows[:n] == rows[width - 1 :]
    return mixed(out[whole]), rows[:n][whole]

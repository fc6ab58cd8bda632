"""Language by n-gram filters that answer for all languages at once.

Counts of character trigrams per language come from all learnable documents. A
trigram belongs to a language if its relative frequency there is at least
``RELATIVE`` of the highest over the languages and at least ``LEAST_SHARE``; the
latter bounds a language's trigrams by 1 / ``LEAST_SHARE``, whatever the corpus size.

The filter is a Bloom filter sliced by bits: a slot holds one bit per language, a
trigram sets the bits of its languages in ``HASHES`` slots, and the AND over these
slots is the set of all languages that contain it. Each language's hits in a text are
corrected for the chance of a false positive (its share of set slots to the
power of ``HASHES``) and set against the share of its own training trigrams that its
filter holds; the highest rate decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytescan as B
from .common import crc_remainder

RELATIVE = 0.5
LEAST_SHARE = 4e-6
LEAST_COUNT = 3
HASHES = 3
SLOTS_PER_ENTRY = 16
FOLDS, HELD_OUT = 3, 1
SLICE_CHARS = 1 << 20
MERGE_AT = 1 << 21
UNDETERMINED = "und"


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram keys around a letter, the row of each, and which rows have a letter.

    Texts are lower-cased; anything but letters is a gap, and so are the ends of a text.
    """
    lowered = [t.lower() for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    points = np.frombuffer("\0".join(lowered + [""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(letters()[points], points, 0).astype(np.uint64)
    before = np.concatenate((np.zeros(1, np.uint64), points[:-1]))
    after = np.concatenate((points[1:], np.zeros(1, np.uint64)))
    at = np.flatnonzero(points)
    keys = before[at] | (points[at] << np.uint64(21)) | (after[at] << np.uint64(42))
    return keys, rows[at], np.bincount(rows[at], minlength=len(texts)) > 0


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE_CHARS`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, inverse, np.concatenate([n for _, n in parts]))
    return keys, totals


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    waiting = 0

    def release() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, totals = _summed(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(totals)],
                names=["lang", "gram", "n"],
            )

    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        langs = batch.column("lang").to_pylist()
        for a, b in _groups(texts):
            keys, rows, _ = trigrams(texts[a:b])
            names = sorted(set(langs[a:b]))
            code = np.array([names.index(x) for x in langs[a:b]])[rows]
            for i, name in enumerate(names):
                found, counts = np.unique(keys[code == i], return_counts=True)
                held.setdefault(name, []).append((found, counts))
                waiting += len(found)
            if waiting >= MERGE_AT:
                held = {name: [_summed(parts)] for name, parts in held.items()}
                waiting = sum(len(p[0][0]) for p in held.values())
                if waiting >= MERGE_AT // 2:
                    yield from release()
                    held, waiting = {}, 0
    yield from release()


class Filter:
    """All languages' trigrams in one bit-sliced Bloom filter."""

    def __init__(self, languages: list[str], grams: np.ndarray, masks: np.ndarray, coverage: np.ndarray):
        self.languages, self.coverage = languages, coverage
        self.size = 1 << max(10, int(SLOTS_PER_ENTRY * max(len(grams), 1) - 1).bit_length())
        self.slots = np.zeros((masks.shape[1], self.size), np.uint64)
        for slot in self._places(grams):
            for word in range(len(self.slots)):
                np.bitwise_or.at(self.slots[word], slot, masks[:, word])
        self.false_rate = np.array(
            [((self.slots[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() ** HASHES for i in range(len(languages))]
        )

    def _places(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        for k in range(1, HASHES + 1):
            yield (B.mixed(grams * np.uint64(2 * k + 1) + np.uint64(k)) & np.uint64(self.size - 1)).astype(np.int64)

    def languages_of(self, grams: np.ndarray) -> np.ndarray:
        """Per word of 64 languages, the mask of languages that contain each trigram."""
        out = None
        for slot in self._places(grams):
            found = self.slots[:, slot]
            out = found if out is None else out & found
        return out

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        keys, rows, lettered = trigrams(texts)
        n = np.maximum(np.bincount(rows, minlength=len(texts)), 1)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        masks = self.languages_of(keys)
        rates = np.empty((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            bit = ((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(bool)
            hits = np.bincount(rows[bit], minlength=len(texts)) / n
            sure = (hits - self.false_rate[i]) / (1 - self.false_rate[i])
            rates[:, i] = np.maximum(sure, 0.0) / self.coverage[i]
        best = rates.argmax(axis=1)
        total = rates.sum(axis=1)
        score = np.where(lettered & (total > 0), rates[np.arange(len(texts)), best] / np.where(total > 0, total, 1.0), 0.0)
        names = [self.languages[b] if has else UNDETERMINED for b, has in zip(best, lettered, strict=True)]
        return names, np.clip(score, 0.0, 1.0)


def fit(rows: DataFrame) -> Filter:
    """A filter from rows of text and non-null lang."""
    counts = rows.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long")
    summed = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = summed.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = summed.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    # one row per trigram, with at most one entry per language
    per_gram = (
        rated.where((F.col("n") >= LEAST_COUNT) & (F.col("rate") >= LEAST_SHARE))
        .groupBy("gram")
        .agg(F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("found"))
        .select("gram", F.filter("found", lambda e: e["rate"] >= F.col("top") * RELATIVE).alias("found"))
        .collect()
    )
    languages = sorted({e["lang"] for r in per_gram for e in r["found"]})
    place = {name: i for i, name in enumerate(languages)}
    masks = np.zeros((len(per_gram), max(1, -(-len(languages) // 64))), np.uint64)
    coverage = np.zeros(len(languages))
    for row, r in enumerate(per_gram):
        for e in r["found"]:
            i = place[e["lang"]]
            masks[row, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            coverage[i] += e["rate"]
    return Filter(languages, np.array([r["gram"] for r in per_gram], np.int64).view(np.uint64), masks, np.maximum(coverage, 1e-6))


def languages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Learns from text and non-null lang of rows whose crc32(id) mod 3 is not 1; rows
    with a null id are neither learned from nor held out. Null texts, texts without a
    letter, and all texts if nothing could be learned, are ``und`` with score 0. Ties go
    to the first language by code point. Repeated rows count as often as they
    occur. An empty table gives an empty result. Other columns play no part.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
    )
    remainder = crc_remainder(F.col("doc_id"), FOLDS)
    model = docs.sparkSession.sparkContext.broadcast(
        fit(rows.where(remainder != HELD_OUT).where("lang IS NOT NULL"))
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _groups(texts):
                names, scores = model.value.judge(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(names, pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"],
                )

    judged = rows.select("doc_id", "text").mapInArrow(judge, "doc_id long, lang_pred string, score double")
    held = F.coalesce(crc_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return judged.select("doc_id", held.alias("held_out"), "lang_pred", "score")

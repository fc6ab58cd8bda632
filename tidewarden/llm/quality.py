"""Quality rules with an isolation forest over their statistics.

One scan gives the rule statistics of every text. The forest isolates rows by random
splits: each tree cuts a subsample at a random value of a random statistic until its
points are alone; rows unlike the sample are alone after few cuts. Trees are built from a
bounded sample of labelled good rows (``TREES`` * ``TREE_ROWS`` at most, those with the
smallest hash of their id); a row's score is 2 ** (-mean path length / expected
length). The threshold comes from all labelled rows: the score that parts the labels
best while rejecting at most ``MOST_GOOD_REJECTED`` of the good ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytescan as B
from .common import settled

LEAST_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WIDTH = 8
TREES = 100
TREE_ROWS = 256
MOST_GOOD_REJECTED = 0.005
BINS = 2000
SEED = 7

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_MARK = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])

FEATURES = ("word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "marks", "distinct", "longest", "line_words")


def _within(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(words: np.ndarray, rows: np.ndarray, n_rows: int, width: int = REPEAT_WIDTH) -> np.ndarray:
    """Per row, the words that lie in a run of ``width`` words found twice or more in the row."""
    if len(words) < width:
        return np.zeros(n_rows, np.int64)
    hashes, owners = B.windows_of(words, rows, width)
    at = np.flatnonzero(rows[: len(rows) - width + 1] == rows[width - 1 :])
    keys = hashes ^ B.mixed(owners.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    ranked = keys[order]
    twice = np.zeros(len(ranked), bool)
    equal = ranked[1:] == ranked[:-1]
    twice[1:] |= equal
    twice[:-1] |= equal
    starts = at[order[twice]]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.bincount(rows[np.cumsum(change[:-1]) > 0], minlength=n_rows)


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def statistics(content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer rule statistics (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)
    and the real-valued ones of ``FEATURES``, one row per text."""
    n = len(bounds) - 1
    starts, ends, rows = B.word_bounds(content, bounds)
    hashes = B.span_hashes(content, starts, ends)
    first = (content & 0xC0) != 0x80
    solid = ~B.SPACE[content]
    n_words = np.bincount(rows, minlength=n)
    chars = _within(first & solid, bounds)
    symbols = _within(_IS_SYMBOL[content], bounds)
    raw = content.tobytes()
    lines = np.array([repeated_lines(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.int64).reshape(n, 2)
    repeats = repeated_words(hashes, rows, n)
    keyed = np.unique(hashes ^ B.mixed(rows.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    distinct = np.bincount(rows[keyed], minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows, ends - starts)
    words, letters = np.maximum(n_words, 1), np.maximum(chars, 1)
    real = np.stack(
        [
            np.log1p(chars / words),
            symbols / (symbols + words),
            lines[:, 1] / np.maximum(lines[:, 0], 1),
            repeats / words,
            _within(_IS_UPPER[content], bounds) / letters,
            _within(_IS_DIGIT[content], bounds) / letters,
            _within(_IS_MARK[content], bounds) / letters,
            np.where(n_words > 0, np.log1p(distinct) / np.log1p(words), 0.0),
            np.log1p(longest),
            np.log1p(words / np.maximum(lines[:, 0], 1)),
        ],
        axis=1,
    )
    return np.stack([n_words, chars, symbols, lines[:, 1], repeats], axis=1), real


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, content, bounds in B.slices(batch.column("text")):
            whole, real = statistics(content, bounds)
            ends = np.arange(0, real.size + 1, real.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, len(whole)),
                    *[pa.array(np.ascontiguousarray(whole[:, k])) for k in range(5)],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(real.ravel())),
                ],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "features"],
            )


def rule_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, the five counts, base_failed and the features of every whole text."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    measured = rows.mapInArrow(_measure, f"doc_id long, {counts}, features array<double>")
    return measured.withColumn("base_failed", failed)


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    longer = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, longer, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Random isolation trees as flat arrays, one row of nodes per tree."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.rows = min(tree_rows, len(sample))
        self.depth = int(np.ceil(np.log2(max(self.rows, 2))))
        size = 2 ** (self.depth + 1)
        self.feature = np.full((trees, size), -1, np.int64)
        self.cut = np.zeros((trees, size))
        self.length = np.zeros((trees, size))
        for tree in range(trees):
            self._grow(tree, 1, sample[draw.choice(len(sample), self.rows, replace=False)], 0, draw)

    def _grow(self, tree: int, node: int, points: np.ndarray, depth: int, draw: np.random.Generator) -> None:
        low, high = (points.min(axis=0), points.max(axis=0)) if len(points) else (np.zeros(1), np.zeros(1))
        varied = np.flatnonzero(high > low)
        if depth >= self.depth or len(points) <= 1 or not len(varied):
            self.length[tree, node] = depth + float(expected_path(len(points)))
            return
        feature = draw.choice(varied)
        cut = draw.uniform(low[feature], high[feature])
        self.feature[tree, node], self.cut[tree, node] = feature, cut
        left = points[:, feature] <= cut
        self._grow(tree, 2 * node, points[left], depth + 1, draw)
        self._grow(tree, 2 * node + 1, points[~left], depth + 1, draw)

    def score(self, points: np.ndarray) -> np.ndarray:
        """0 to 1; higher for rows that few cuts isolate."""
        total = np.zeros(len(points))
        every = np.arange(len(points))
        for feature, cut, length in zip(self.feature, self.cut, self.length, strict=True):
            node = np.ones(len(points), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                right = points[every, np.maximum(f, 0)] > cut[node]
                node = np.where(f >= 0, 2 * node + right, node)
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / max(float(expected_path(self.rows)), 1e-9))


def _labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    return stats.where("NOT base_failed").join(known, "doc_id")


def threshold(scored: DataFrame, labels: DataFrame, most_good: float = MOST_GOOD_REJECTED, bins: int = BINS) -> float:
    """The rejecting score, from a histogram over all labelled rows; 2.0 rejects nothing."""
    rows = (
        _labelled(scored, labels)
        .groupBy(F.floor(F.col("score") * bins).cast("int").alias("bin"), "quality")
        .count()
        .collect()
    )
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for at, quality, n in rows:
        (good if quality else bad)[at] += n
    if not good.sum() or not bad.sum():
        return 2.0
    good_over, bad_over = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (good, bad))
    gain = np.where(good_over <= most_good, bad_over - good_over, -1.0)
    best = int(np.argmax(gain))
    return best / bins if gain[best] > 0 else 2.0


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    trees: int = TREES, tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """doc_id, the five counts, base_failed, score, and kept of every row.

    ``kept`` is false where the base rules fail or the score reaches the calibrated
    threshold. Null and empty texts have no words and fail the base rules. Equal texts
    get equal verdicts; repeated and null ids are ordinary rows, but only rows with an
    id can be labelled, and repeated labels count with the lower one. Without labels of
    both kinds the forest rejects nothing. An empty table gives an empty result.
    """
    stats = settled(rule_statistics(docs, id_column, text_column), "quality-stats")
    sample = (
        _labelled(stats, labels)
        .where("quality = 1")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(trees * tree_rows)
        .select("features")
        .collect()
    )
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    if not sample:
        return stats.select(*counts, F.lit(0.0).alias("score"), (~F.col("base_failed")).alias("kept"))
    forest = docs.sparkSession.sparkContext.broadcast(
        Forest(np.array([r[0] for r in sample]), trees, tree_rows)
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            kept = [batch.column(c) for c in counts]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(forest.value.score(points))], names=[*counts, "score"])

    types = dict(stats.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in counts) + ", score double"
    scored = settled(stats.mapInArrow(judge, schema), "quality-scores")
    limit = threshold(scored, labels)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") < F.lit(limit)))

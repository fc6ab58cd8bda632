"""Hard negatives by Four-Russians scoring.

Candidates are stored as bit planes: bit b of eight neighbouring components is one byte. For an
anchor and a group of eight dimensions a table holds the sum of the anchor's components for
each of the 256 subsets. A score is then one lookup per byte: plane by plane from the top,
the sums of all groups are added and shifted on (the top plane, the sign, counts
negative). Every score is exact.

Anchors are a stated query set. They are dealt to blocks, candidates to slices, both of
bounded size; every block meets every slice in one task, which keeps the best few per anchor
(and per positive), so what leaves it does not depend on the slice's size. Within a task rows
are ordered by label: positives look at the rows of the anchor's label, negatives at all others, so every
pair is scored once over both steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled
from .vectors import integers, of_common_length, usable

GROUP = 8
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least 30 and at most 90 hundredths of the positive's.
LEAST_SHARE, MOST_SHARE = 30, 90
ANCHOR_ROWS = 4096
SLICE_ROWS = 1 << 17
#: Candidates and anchors scored at once inside a task.
STRIP, TOGETHER = 2048, 128


# Scoring ---------------------------------------------------------------------------


def bit_planes(x: np.ndarray, planes: int) -> np.ndarray:
    """Bytes (rows, planes, groups) of two's complement vectors."""
    rows, d = x.shape
    wide = np.zeros((rows, -(-d // GROUP) * GROUP), np.int64)
    wide[:, :d] = x
    bits = (wide[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(x: np.ndarray) -> np.ndarray:
    """Tables (groups, 256, anchors): the sum of each subset of eight components."""
    anchors, d = x.shape
    groups = -(-d // GROUP)
    wide = np.zeros((anchors, groups * GROUP), np.int64)
    wide[:, :d] = x
    wide = wide.reshape(anchors, groups, GROUP)
    table = np.zeros((groups, 1 << GROUP, anchors), np.int64)
    for k in range(GROUP):
        half = 1 << k
        table[:, half : 2 * half] = table[:, :half] + wide[:, :, k].T[:, None, :]
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors) from lookups, additions and shifts."""
    rows, count, groups = planes.shape
    total = np.zeros((rows, table.shape[2]), table.dtype)
    for b in range(count - 1, -1, -1):
        here = table[0].take(planes[:, b, 0], axis=0)
        for g in range(1, groups):
            here += table[g].take(planes[:, b, g], axis=0)
        total <<= 1
        if b == count - 1:
            total -= here
        else:
            total += here
    return total


class _Best:
    """The highest scores per column seen so far, ties by smaller id."""

    def __init__(self, columns: int, most: int):
        self.most = most
        self.score = np.full((0, columns), np.iinfo(np.int64).min)
        self.ids = np.zeros((0, columns), np.int64)
        self.has = np.zeros((0, columns), bool)

    def add(self, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Rows of ``score`` belong to rising ``ids``; only ``allowed`` entries count."""
        rows = len(score)
        lowest = np.where(allowed, score, np.iinfo(np.int64).min)
        if rows > self.most:
            # the last score that can be among the best, then all rows that reach it anywhere
            cut = np.partition(lowest, rows - self.most, axis=0)[rows - self.most]
            pick = np.flatnonzero((allowed & (lowest >= cut)).any(axis=1))
            score, ids, allowed = score[pick], ids[pick], allowed[pick]
        self.score = np.concatenate((self.score, score))
        self.ids = np.concatenate((self.ids, np.broadcast_to(ids[:, None], score.shape)))
        self.has = np.concatenate((self.has, allowed))
        order = np.lexsort((self.ids, -self.score, ~self.has), axis=0)[: self.most]
        self.score, self.ids, self.has = (np.take_along_axis(a, order, axis=0) for a in (self.score, self.ids, self.has))


class _Slice:
    """Candidates of one slice in order of label and id."""

    def __init__(self, table: pa.Table, planes: int, groups: int):
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        packed = np.frombuffer(b"".join(table.column("planes").to_pylist()), np.uint8)
        self.planes = packed.reshape(-1, planes, groups)[order]

    def strips(self, label: int, same: bool) -> Iterator[slice]:
        a, b = np.searchsorted(self.labels, [label, label + 1]) if label < np.iinfo(np.int64).max else (
            np.searchsorted(self.labels, label), len(self.labels))
        for first, end in ((a, b),) if same else ((0, a), (b, len(self.labels))):
            for at in range(first, end, STRIP):
                yield slice(at, min(at + STRIP, end))


def _groups_of(labels: np.ndarray, ids: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of rows of one label, a bounded number at once, those of one id side by side."""
    order = np.lexsort((ids, labels))
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    for part in np.split(order, cuts):
        for at in range(0, len(part), TOGETHER):
            yield part[at : at + TOGETHER]


def _columns(found: list[tuple], names: tuple) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * len(names)
    return pa.table(dict(zip(names, map(pa.array, columns), strict=True)))


def _ordered(score: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    return score[order], ids[order]


class _Scorer:
    """What a task needs to know: shape, number of planes, and whether sums fit 32 bits."""

    def __init__(self, d: int, planes: int, most: int):
        self.d, self.planes, self.groups = d, planes, -(-d // GROUP)
        self.kind = np.int32 if d * most * most < 1 << 30 else np.int64

    def anchors(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, self.d)
        return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), x

    def positives(self, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and candidates.num_rows:
            ids, labels, x = self.anchors(anchors)
            rows = _Slice(candidates, self.planes, self.groups)
            for part in _groups_of(labels, ids):
                table = subset_sums(x[part]).astype(self.kind)
                best = _Best(len(part), POSITIVES)
                for strip in rows.strips(labels[part[0]], same=True):
                    score, there = _ordered(scores(table, rows.planes[strip]).astype(np.int64), rows.ids[strip])
                    best.add(score, there, there[:, None] != ids[part][None, :])
                at, column = np.nonzero(best.has)
                out.append((ids[part][column], best.ids[at, column], best.score[at, column]))
        return _columns(out, ("anchor_id", "other_id", "score"))

    def negatives(self, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        """``anchors`` has one row per anchor and positive."""
        out = []
        if anchors.num_rows and candidates.num_rows:
            ids, labels, x = self.anchors(anchors)
            bound, positive = (anchors.column(c).to_numpy() for c in ("positive_score", "positive_id"))
            rows = _Slice(candidates, self.planes, self.groups)
            low, high = -(-LEAST_SHARE * bound // 100), MOST_SHARE * bound // 100
            for part in _groups_of(labels, ids):
                # pairs of one anchor share its table
                own, which = np.unique(ids[part], return_index=True)
                place = np.searchsorted(own, ids[part])
                table = subset_sums(x[part[which]]).astype(self.kind)
                best = _Best(len(part), NEGATIVES)
                for strip in rows.strips(labels[part[0]], same=False):
                    score, there = _ordered(scores(table, rows.planes[strip]).astype(np.int64), rows.ids[strip])
                    score = score[:, place]
                    best.add(score, there, (score >= low[part]) & (score <= high[part]))
                at, column = np.nonzero(best.has)
                mine = part[column]
                out.append((ids[mine], positive[mine], bound[mine], best.ids[at, column], best.score[at, column]))
        return _columns(out, ("anchor_id", "positive_id", "positive_score", "other_id", "score"))


# The joins of blocks and slices ------------------------------------------------------


def _packed(rows: DataFrame, d: int, planes: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            held = [p.tobytes() for p in bit_planes(x, planes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("slice"), pa.array(held, pa.binary())],
                names=["vec_id", "label", "slice", "planes"],
            )

    return rows.mapInArrow(pack, "vec_id long, label long, slice int, planes binary")


def _met(anchors: DataFrame, candidates: DataFrame, blocks: int, slices: int, step, schema: str) -> DataFrame:
    """``step`` on every block of anchors beside every slice of candidates."""
    one = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    other = candidates.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keys = ["block", "slice"]
    return one.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInArrow(step, schema)


def _first(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The best rows per key with their rank; each task's own surplus goes before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    frame: DataFrame,
    anchors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    slice_rows: int = SLICE_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``anchors`` has the anchors' ids in ``id_column``. Components c become floor(256 * c); a score is the integer
    inner product with the anchor, higher first, ties by smaller id. An anchor's
    positives are its first 5 other rows of the same label; for each of them the first
    10 rows of other labels whose score is at least 30 and at most 90 hundredths of the positive's
    are returned (none qualify under a negative positive score).

    Rows with a null id, label or vector and rows whose vector is empty or holds null,
    non-finite or huge (2**32 and more) components take no part, nor do vectors of another length
    than the most frequent one. Of rows that share an id the one with the smallest
    label and vector counts. Labels are whole numbers. Ids in ``anchors`` that are null,
    repeated or unknown change nothing. An empty table gives an empty result. Other columns play no part.
    """
    rows = frame.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"), F.col(vector_column).alias("v")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    rows, d = of_common_length(rows.select("vec_id", "label", integers(F.col("v")).alias("x")))
    one = F.min(F.struct("label", "x")).alias("one")
    rows = settled(rows.groupBy("vec_id").agg(one).select("vec_id", "one.label", "one.x"), "negative-rows")
    asked = anchors.select(F.col(id_column).cast("long").alias("vec_id")).distinct()
    picked = settled(rows.join(asked, "vec_id", "left_semi"), "negative-anchors")
    size = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.greatest(F.array_max("x"), -F.array_min("x"))).alias("most"),
    ).first()
    asked_rows = picked.count()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not asked_rows:
        return rows.sparkSession.createDataFrame([], result)
    planes = int(size.most).bit_length() + 1
    scorer = _Scorer(d, planes, int(size.most))
    blocks = -(-asked_rows // anchor_rows)
    # at least as many pieces as tasks that can run, at most slice_rows rows each
    parallel = -(-rows.sparkSession.sparkContext.defaultParallelism // blocks)
    slices = max(-(-size.n // slice_rows), min(2 * parallel, -(-size.n // STRIP)))
    dealt = F.pmod(F.xxhash64(F.lit("slice"), "vec_id"), F.lit(slices)).cast("int")
    candidates = settled(_packed(rows.withColumn("slice", dealt), d, planes), "negative-planes")
    blocked = picked.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)).cast("int"))

    def positives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        return scorer.positives(anchors, candidates)

    near = _first(_met(blocked, candidates, blocks, slices, positives, "anchor_id long, other_id long, score long"), ["anchor_id"], POSITIVES)
    pairs = near.where("score >= 0").select(
        F.col("anchor_id").alias("vec_id"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    asking = settled(pairs.join(blocked, "vec_id"), "negative-pairs")

    def negatives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        return scorer.negatives(anchors, candidates)

    made = "anchor_id long, positive_id long, positive_score long, other_id long, score long"
    hard = _first(_met(asking, candidates, blocks, slices, negatives, made), ["anchor_id", "positive_id"], NEGATIVES)
    return hard.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )

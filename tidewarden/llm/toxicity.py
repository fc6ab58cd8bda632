"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Fit: a bounded sample of labelled rows (``EXAMPLES`` of each label, those with the
smallest hash of their id) gives the terms whose presence differs most between the
labels (at most ``TERMS``, by a two-proportion z-score, and ``LEAST_RATIO`` times as common in one) and, as sparse vectors over
these terms, the examples. Document frequencies come from all documents. Sample,
terms and index are bounded by these two parameters, whatever the tables' size, and
are the only things sent to the tasks.

Search: the examples are ordered so that like ones are neighbours and cut into
blocks; an inverted index lists per term its blocks with the largest weight in each
and the postings behind them. A text bounds every block by its block maxima, opens
blocks from the highest bound down and stops when no bound beats the worst of the
nearest examples so far, so the result is exact.

Score: votes weighted by similarity and by how many labelled rows an example stands
for, made a probability by a monotone fit on the examples themselves, each scored
without its own vote. A text without any of the terms has no neighbour and gets the
share of label 1 among such rows.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, settled

EXAMPLES = 6000
TERMS = 4096
LEAST_Z = 5.0
LEAST_RATIO = 4.0
LEAST_ROWS = 3
NEIGHBOURS = 15
BLOCK = 64
EVIDENCE = 3

_OTHER = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return (text or "").lower().encode("utf-8", "replace").translate(_OTHER).split()


class Index:
    """Examples over selected terms, searched by cosine."""

    def __init__(self, terms: list[bytes], idf: np.ndarray):
        self.number = {t: i for i, t in enumerate(terms)}
        self.known = frozenset(terms)
        self.idf = idf
        self.ids = np.zeros(0, np.int64)
        self.labels = np.zeros(0, np.int8)
        self.stands_for = np.zeros(0)
        self.prior = 0.0
        self.knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def vector(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of unit length."""
        found = self.known.intersection(words)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        counts = Counter(w for w in words if w in found)
        order = sorted((self.number[w], n) for w, n in counts.items())
        numbers = np.array([n for n, _ in order], np.int64)
        weights = (1.0 + np.log([n for _, n in order])) * self.idf[numbers]
        return numbers, weights / np.sqrt((weights**2).sum())

    def build(self, rows: list[tuple[int, int, list, list]], weight: tuple[float, float]) -> None:
        """rows: id, label, term numbers and weights of every example with a term."""
        rows = sorted(rows, key=lambda r: (r[2][int(np.argmax(r[3]))], sorted(r[2]), r[0]))
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int8)
        self.stands_for = np.array(weight)[self.labels]
        lengths = [len(r[2]) for r in rows]
        term = np.array(list(itertools.chain.from_iterable(r[2] for r in rows)), np.int64)
        value = np.array(list(itertools.chain.from_iterable(r[3] for r in rows)))
        owner = np.repeat(np.arange(len(rows)), lengths)
        order = np.lexsort((owner, term))
        self.post_owner, self.post_value, term = owner[order], value[order], term[order]
        block = self.post_owner // BLOCK
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.entry_start = np.append(np.flatnonzero(new), len(term)).astype(np.int64)
        self.entry_block = block[new]
        self.entry_max = np.maximum.reduceat(self.post_value, self.entry_start[:-1]) if len(term) else np.zeros(0)
        self.term_start = np.searchsorted(term[new], np.arange(len(self.idf) + 1))
        self.blocks = -(-len(rows) // BLOCK)

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine (ties by example order) and the cosines; exact."""
        spans = [np.arange(self.term_start[t], self.term_start[t + 1]) for t in numbers]
        entries = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        if not len(entries):
            return np.zeros(0, np.int64), np.zeros(0)
        factor = np.repeat(weights, [len(s) for s in spans])
        bound = np.bincount(self.entry_block[entries], factor * self.entry_max[entries], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, scores = np.zeros(0, np.int64), np.zeros(0)
        step, at = 4, 0
        while at < len(order):
            if len(scores) >= k and bound[order[at]] < scores[k - 1] - 1e-12:
                break
            opened = np.zeros(self.blocks, bool)
            opened[order[at : at + step]] = True
            use = opened[self.entry_block[entries]]
            starts, ends = self.entry_start[entries[use]], self.entry_start[entries[use] + 1]
            lengths = ends - starts
            where = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
            owners, local = np.unique(self.post_owner[where], return_inverse=True)
            sums = np.bincount(local, np.repeat(factor[use], lengths) * self.post_value[where])
            keep = owners != without
            best, scores = np.concatenate((best, owners[keep])), np.concatenate((scores, sums[keep]))
            top = np.lexsort((best, -np.round(scores, 12)))[:k]
            best, scores = best[top], scores[top]
            at, step = at + step, step * 2
        return best, scores

    def vote(self, best: np.ndarray, scores: np.ndarray) -> float:
        if not len(best):
            return -1.0
        power = np.maximum(scores, 0.0) ** 2 * self.stands_for[best]
        return float((power * self.labels[best]).sum() / max(power.sum(), 1e-300))

    def calibrate(self, rows: list[tuple[int, int, list, list]], weight: tuple[float, float], bare: tuple[int, int]) -> None:
        """Fit the probability of label 1 to the votes, and to having no term at all."""
        none = [bare[0] * weight[0], bare[1] * weight[1]]
        self.prior = (none[1] + 0.01) / (sum(none) + 1.0)
        place = {i: n for n, i in enumerate(self.ids)}
        pairs = []
        for doc_id, label, numbers, values in rows:
            found = self.nearest(np.array(numbers, np.int64), np.array(values), NEIGHBOURS, place[doc_id])
            pairs.append((self.vote(*found), label))
        seen = sorted(p for p in pairs if p[0] >= 0)
        if seen:
            votes, labels = np.array([p[0] for p in seen]), np.array([p[1] for p in seen])
            self.knots = _monotone(votes, labels, np.array(weight)[labels])

    def score(self, vote: float) -> float:
        if vote < 0:
            return self.prior
        fitted = float(np.interp(vote, *self.knots))
        return min(max(0.995 * fitted + 0.005 * vote, 0.0), 1.0)


def _monotone(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a non-decreasing fit: pool neighbours until their means rise."""
    pools: list[list[float]] = []
    for value, label, w in zip(x, y, weight, strict=True):
        pools.append([w * value, w * label, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    level = np.array([(p[1] + 0.02) / (p[2] + 0.04) for p in pools])
    return np.array([p[0] / p[2] for p in pools]), np.maximum.accumulate(level)


def labelled_sample(labels: DataFrame, learn_from, examples: int = EXAMPLES) -> tuple[DataFrame, tuple[int, int]]:
    """At most ``examples`` ids of each label, and how many rows each label has."""
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(learn_from)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = dict(rows.groupBy("toxic").count().collect())
    picked = [rows.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for t in (0, 1)]
    return picked[0].union(picked[1]), (counts.get(0, 0), counts.get(1, 0))


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [terms_of(t) for t in batch.column("text").to_pylist()]
        distinct = [sorted(set(w)) for w in words]
        ends = np.concatenate(([0], np.cumsum([len(d) for d in distinct]))).astype(np.int32)
        flat = pa.array(list(itertools.chain.from_iterable(distinct)), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.ListArray.from_arrays(pa.array(ends), flat)],
            names=["doc_id", "toxic", "terms"],
        )


def _chosen_terms(sample: DataFrame, terms: int) -> list[bytes]:
    rows = sample.mapInArrow(_sample_terms, "doc_id long, toxic int, terms array<binary>")
    totals = dict(sample.groupBy("toxic").count().collect())
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return []
    counts = (
        rows.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    )
    pool = (F.col("a") + F.col("b") + 1) / F.lit(float(n0 + n1 + 2))
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(pool * (1 - pool) * F.lit(1 / n0 + 1 / n1))
    chosen = (
        counts.where(F.col("a") + F.col("b") >= LEAST_ROWS)
        .withColumns({"z": F.abs(z), "ratio": F.abs(F.log((F.col("a") + 0.5) / n1) - F.log((F.col("b") + 0.5) / n0))})
        .where((F.col("z") >= LEAST_Z) & (F.col("ratio") >= math.log(LEAST_RATIO)))
        .orderBy(F.desc("z"), "term")
        .limit(terms)
    )
    return [bytes(r["term"]) for r in chosen.select("term").collect()]


def _document_counts(docs: DataFrame, terms: list[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each term occurs, and the number of documents; all are read."""
    known = frozenset(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(known.intersection(terms_of(text.as_py())))
            seen[b""] += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"]
        )

    rows = docs.select("text").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n")).collect()
    counts = {bytes(r[0]): r[1] for r in rows}
    return counts, counts.pop(b"", 0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn_from,
    examples: int = EXAMPLES,
    terms: int = TERMS,
) -> Index:
    """An index of labelled examples. ``docs`` has doc_id and text; ``learn_from`` selects label rows.

    Label rows with null id or a label other than 0 and 1 are left out, repeated ids
    count once with their highest label, and ids without a document are not used.
    """
    ids, totals = labelled_sample(labels, learn_from, examples)
    # at most 2 * examples ids
    sample = settled(
        docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")),
        "toxicity-sample",
    )
    chosen = _chosen_terms(sample, terms)
    counts, n_docs = _document_counts(docs, chosen)
    idf = np.log((1.0 + n_docs) / (1.0 + np.array([counts.get(t, 0) for t in chosen], float))) + 1.0
    index = Index(chosen, idf)
    rows, bare, drawn = [], [0, 0], [0, 0]
    vectors = sample.mapInArrow(_vectors_with(index), "doc_id long, toxic int, terms array<long>, weights array<double>")
    for doc_id, toxic, numbers, values in vectors.collect():
        drawn[toxic] += 1
        if numbers:
            rows.append((doc_id, toxic, numbers, values))
        else:
            bare[toxic] += 1
    weight = tuple(t / d if d else 0.0 for t, d in zip(totals, drawn, strict=True))
    rows.sort()
    index.build(rows, weight)
    index.calibrate(rows, weight, tuple(bare))
    return index


def _vectors_with(index: Index):
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [index.vector(terms_of(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.float64())),
                ],
                names=["doc_id", "toxic", "terms", "weights"],
            )

    return vectors


def _judged(index: Index, texts: pa.Array) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    for text in texts:
        best, scores = index.nearest(*index.vector(terms_of(text.as_py())), NEIGHBOURS)
        yield index.score(index.vote(best, scores)), best, scores


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 5
) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row.

    Labels are learned from rows whose crc32(id) mod ``folds`` is not 0; ``held_out``
    marks the others (false for a null id). Null and empty texts have no term and get
    the score of such texts. Equal texts get equal scores. Without labels of both
    kinds every score is the share of label 1 (0.01 without labels). ``evidence`` lists the nearest
    examples. An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    index = fit(rows, labels, crc_remainder(F.col("doc_id"), folds) != 0)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            found = list(_judged(index, batch.column("text")))
            evidence = [
                [
                    {"doc_id": int(index.ids[b]), "similarity": float(s), "toxic": int(index.labels[b])}
                    for b, s in zip(best[:EVIDENCE], scores[:EVIDENCE], strict=True)
                ]
                for _, best, scores in found
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.float64()), pa.array(evidence, _EVIDENCE)],
                names=["doc_id", "score", "evidence"],
            )

    scored = rows.mapInArrow(
        judge, "doc_id long, score double, evidence array<struct<doc_id: long, similarity: double, toxic: int>>"
    )
    return scored.select(
        "doc_id",
        F.coalesce(crc_remainder(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 5
) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, with their own columns."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    index = fit(rows, labels, crc_remainder(F.col("doc_id"), folds) != 0)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    at = docs.columns.index(text_column)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            yield batch.filter(pa.array([score < 0.5 for score, _, _ in _judged(shared.value, texts)], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)

"""Embedding whitening by QDWH spectral divide-and-conquer.

Three scans of the vectors, each reduced to sums of fixed size on the way: exact sums
per dimension, the covariance of the centred vectors, and the covariance of the
whitened vectors as a check. Only the d x d covariance reaches the driver.

There it is split by polar decompositions: for a shift s between eigenvalues the
unitary polar factor U of V - s*I has eigenvalues +1 above and -1 below, so
(U + I) / 2 projects on the invariant subspace above the shift. Bases of both
subspaces come from QR, the two compressed problems are split in turn until a block
is a single direction or cannot be told from a multiple of the identity. U is computed by
the QR form of the dynamically weighted Halley iteration, which needs no inverse.

The whitening itself is a scan with the components broadcast (d x k numbers).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled
from .vectors import integers, of_common_length, usable

COMPONENTS = 4
EPS = np.finfo(float).eps
#: Vectors turned into doubles at once.
BLOCK = 8192


# Spectral divide-and-conquer ---------------------------------------------------


def polar_factor(a: np.ndarray, most: int = 40) -> np.ndarray:
    """The unitary factor of a square matrix by QDWH with QR steps."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)  # at least the largest singular value
    low = EPS  # a lower bound of the least singular value; smaller ones count as no direction
    for _ in range(most):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, np.eye(n))))
        fresh = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        moved = np.linalg.norm(fresh - x)
        x = fresh
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its complement."""
    n = len(projector)
    start = np.argsort(-np.diag(projector), kind="stable")
    q, _ = np.linalg.qr(projector[:, start[:rank]])
    for _ in range(2):  # subspace steps: the projector itself is the iteration matrix
        q, _ = np.linalg.qr(projector @ q)
    full, _ = np.linalg.qr(np.hstack((q, (np.eye(n) - projector)[:, start[::-1][: n - rank]])))
    return full[:, :rank], full[:, rank:]


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two complementary invariant subspaces, the upper one first; None where the
    eigenvalues cannot be told apart."""
    n = len(a)
    scale = np.linalg.norm(a)
    mean = np.trace(a) / n
    if np.linalg.norm(a - mean * np.eye(n)) <= 4 * n * EPS * scale:
        return None
    best = None
    diagonal = np.sort(np.diag(a))
    # the mean always has eigenvalues on both sides; the others split more evenly
    for shift in (np.median(diagonal), mean, 0.5 * (diagonal[-1] + mean), 0.5 * (diagonal[0] + mean)):
        u = polar_factor(a - shift * np.eye(n))
        u = (u + u.T) / 2
        rank = int(round((np.trace(u) + n) / 2))
        if not 0 < rank < n:
            continue
        above, below = _bases((u + np.eye(n)) / 2, rank)
        left = np.linalg.norm(below.T @ a @ above)
        if best is None or left < best[0]:
            best = (left, above, below)
        if left <= 10 * n * EPS * scale:
            break
    return None if best is None else best[1:]


def spectral_divide(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix.

    Equal eigenvalues get any orthonormal basis of their space.
    """
    n = len(a)
    values, vectors = np.zeros(n), np.zeros((n, n))
    pending = [(np.eye(n), (a + a.T) / 2)]
    at = 0
    while pending:
        basis, block = pending.pop()
        parts = None if len(block) == 1 else _split(block)
        if parts is None:
            values[at : at + len(block)] = np.diag(block)
            vectors[:, at : at + len(block)] = basis
            at += len(block)
            continue
        for part in parts:
            inner = part.T @ block @ part
            pending.append((basis @ part, (inner + inner.T) / 2))
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# Sums over the vectors -------------------------------------------------------------


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)  # components are below 2**40, so 2**23 rows are safe
        for batch in batches:
            n += batch.num_rows
            total += _matrix(batch.column("x"), d).sum(axis=0)
            if n >= 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d)), pa.array([n, *total.tolist()])], names=["i", "v"])
                n, total = 0, np.zeros(d, np.int64)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d)), pa.array([n, *total.tolist()])], names=["i", "v"])

    parts = vectors.select("x").mapInArrow(add, "i long, v long")
    found = {r.i: int(r.v) for r in parts.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(d)]


def _moments(vectors: DataFrame, d: int, centre: np.ndarray, basis: np.ndarray | None, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and sum of outer products of (x - centre) @ basis - after over all vectors.

    Every task adds up its own k x k products; they meet in an aggregation keyed by entry.
    """
    k = d if basis is None else basis.shape[1]
    upper = np.triu_indices(k)
    places = np.concatenate((np.arange(k) + k * k, upper[0] * k + upper[1]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            rows = _matrix(batch.column("x"), d)
            for first in range(0, len(rows), BLOCK):
                c = rows[first : first + BLOCK] - centre
                c = (c if basis is None else c @ basis) - after
                total += c.sum(axis=0)
                products += c.T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(places), pa.array(np.concatenate((total, products[upper])))], names=["i", "v"]
        )

    found = vectors.select("x").mapInArrow(add, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    flat = np.zeros(k * k + k)
    flat[found["i"].to_numpy()] = found["v"].to_numpy()
    products = flat[: k * k].reshape(k, k)
    return flat[k * k :], products + np.triu(products, 1).T


class Whitening:
    """Counts, sums, components and eigenvalues of a fit list; small enough to ship to tasks."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float, error: float | None):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors
        self.trace, self.identity_error = trace, error

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / max(self.n, 1) for s in self.sums])

    @property
    def scaled(self) -> np.ndarray:
        """Components over the square roots of their eigenvalues; NaN without variance."""
        flat = self.values <= len(self.sums) * EPS * self.trace
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(flat, np.nan, self.vectors / np.sqrt(np.where(flat, 1.0, self.values)))


def fitted(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of a table of vectors ``x``, each counted once per row."""
    n, sums = _sums(vectors, d)
    mean = np.array([s / max(n, 1) for s in sums])
    left_over, products = _moments(vectors, d, mean, None, np.zeros(d))
    # centring leaves a sum of rounding errors, taken out of the products as well
    drift = left_over / max(n, 1)
    covariance = products / max(n, 1) - np.outer(drift, drift)
    values, axes = spectral_divide(covariance)
    k = min(components, d)
    made = Whitening(n, sums, values[:k], axes[:, :k], float(np.trace(covariance)), None)
    scaled = made.scaled
    real = ~np.isnan(scaled).any(axis=0)
    if real.any():
        basis = scaled[:, real]
        _, square = _moments(vectors, d, mean, basis, drift @ basis)
        made.identity_error = float(np.abs(square / n - np.eye(basis.shape[1])).max())
    return made


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum over dimensions of (n*x - S)**2, exact; null beyond a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if len(sums) * most * most < 1 << 63:
        part = n * x - np.array(sums, np.int64)
        return (part * part).sum(axis=1).tolist()
    part = n * x.astype(object) - np.array(sums, object)
    found = (part * part).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in found]


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(
    frame: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Every usable row and its coordinates along the leading principal components.

    Components c of a vector become x = floor(256 * c). Rows whose vector is null or empty
    or holds null, non-finite or huge (2**32 and more) components are left out, as are
    vectors of another length than the most frequent one. The fit list holds each
    distinct x vector once; n counts it, S are its sums. Columns: vec_id, component (from 1, falling
    eigenvalue), n, deviation (sum of (n*x - S)**2, null beyond a long), whitened, explained (share of
    the trace), identity_error (largest entry of whitened's covariance minus the identity).

    Directions without variance (fewer distinct vectors than dimensions, a single
    vector) have a null ``whitened``; without any variance ``explained`` and
    ``identity_error`` are null too. Rows that repeat an id or have none are rows like all
    others. An empty table gives an empty result. Other columns play no part.
    """
    rows = frame.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))
    rows = rows.where(usable(F.col("v"))).select("vec_id", integers(F.col("v")).alias("x"))
    rows, d = of_common_length(settled(rows, "whitening-integers"))
    if not d:
        return rows.sparkSession.createDataFrame([], _RESULT)
    model = fitted(settled(rows.select("x").distinct(), "whitening-fit"), d, components)
    held = rows.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        k, mean, scaled = len(m.values), m.mean, m.scaled
        share = m.values / m.trace if m.trace > 0 else np.full(k, np.nan)
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                x = _matrix(part.column("x"), d)
                size = len(x)
                if not size:
                    continue
                ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(size), k)))
                deviation = pa.array(_deviations(x, m.n, m.sums), pa.int64()).take(pa.array(np.repeat(np.arange(size), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, m.n)),
                        deviation,
                        pa.array(((x - mean) @ scaled).ravel(), from_pandas=True),
                        pa.array(np.tile(share, size), from_pandas=True),
                        pa.array([m.identity_error] * (size * k), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, _RESULT)

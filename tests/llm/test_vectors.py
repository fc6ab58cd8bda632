"""Whitening and hard negatives against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tests.llm.corpus import HAVE_TABLES
from tidewarden.llm import negatives, registry, whitening

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
SCHEMA = "vec_id long, embedding array<float>, label int, x string, rank int, slice int, block string"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, 2, "b") for i, v, lab in rows], SCHEMA)


def awkward_vectors(n=60, d=11):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=d) * (1 + np.arange(d) / 3)], int(i % 3)) for i in range(n)]
    rows += [(100, None, 1), (101, [], 1), (102, [1.0] * (d - 1) + [None], 1), (103, [math.nan] + [1.0] * (d - 1), 1),
             (104, [math.inf] * d, 1), (105, [1.0] * (d + 2), 1), (None, rows[3][1], 1), (106, rows[4][1], None), (107, [1e30] * d, 0)]
    return rows + [(200, rows[0][1], 2), (200, rows[0][1], 2), (201, rows[0][1], 0)]


# Spectral divide-and-conquer ---------------------------------------------------------


def matrices():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 40):
        m = rng.normal(size=(n, n))
        q, _ = np.linalg.qr(m)
        yield m @ m.T
        yield m + m.T
        yield np.diag(np.arange(n) + 1.0)
        yield np.eye(n) * 3
        yield q @ np.diag([5.0] * (n // 2) + [1.0] * (n - n // 2)) @ q.T
        yield m[:, :2] @ m[:, :2].T
        yield q @ np.diag(10.0 ** -np.arange(n)) @ q.T
        yield np.zeros((n, n))


@pytest.mark.parametrize("a", list(matrices()), ids=lambda a: f"{len(a)}")
def test_spectral_divide(a):
    values, vectors = whitening.spectral_divide(a)
    scale = max(np.abs(a).max(), 1e-300) * len(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-13 * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(len(a)), atol=1e-13)
    assert np.allclose(a @ vectors, vectors * values, rtol=0, atol=1e-13 * scale)


def test_polar_factor_is_the_sign_of_a_symmetric_matrix():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    signs = np.sign(rng.normal(size=20))
    a = q @ np.diag(signs * 10.0 ** rng.uniform(-9, 3, 20)) @ q.T
    assert np.allclose(whitening.polar_factor(a), q @ np.diag(signs) @ q.T, atol=1e-6)


# Whitening ---------------------------------------------------------------------------


def expected_whitening(rows, components=4):
    d = max(len(v) for _, v, _ in rows[:5])
    good = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in rows
            if v is not None and len(v) == d and all(c is not None and math.isfinite(c) and abs(c) < 2**32 for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}), float)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    x = np.array([x for _, x in good], float)
    return good, n, sums, (x - sums / n) @ vectors / np.sqrt(values), values / np.trace(c.T @ c / n)


def test_whitening_equals_brute_force(spark):
    rows = awkward_vectors()
    good, n, sums, wanted, share = expected_whitening(rows)
    found = whitening.whitened(rows_of(spark, rows)).collect()
    assert len(found) == 4 * len(good) and {r.n for r in found} == {n} and n == 60
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    key = lambda r: (r.vec_id is None, r.vec_id)
    ids = sorted((i for i, _ in good), key=lambda i: (i is None, i))
    for k in range(4):
        mine = sorted((r for r in found if r.component == k + 1), key=key)
        assert [r.vec_id for r in mine] == ids
        order = sorted(range(len(good)), key=lambda j: (good[j][0] is None, good[j][0]))
        column = np.array([r.whitened for r in mine])
        sign = np.sign((column * wanted[order, k]).sum())
        assert np.allclose(column, sign * wanted[order, k], atol=1e-9)
        assert abs(mine[0].explained - share[k]) < 1e-12
        exact = [int(sum((n * v - int(s)) ** 2 for v, s in zip(good[j][1], sums, strict=True))) for j in order]
        assert [r.deviation for r in mine] == exact


@pytest.mark.parametrize(("rows", "components", "flat"), [
    ([(1, [1.0, 2.0], 0)], 2, 2),
    ([(1, [1.0, 2.0], 0), (2, [1.0, 3.0], 0), (3, [1.0, 3.0], 0)], 2, 1),
    ([(1, [7.0], 0), (2, [9.0], 0)], 1, 0),
])
def test_directions_without_variance_have_no_coordinate(spark, rows, components, flat):
    found = whitening.whitened(rows_of(spark, rows)).collect()
    assert len(found) == components * len(rows)
    assert {r.component for r in found if r.whitened is None} == set(range(components - flat + 1, components + 1))
    assert (found[0].identity_error is None) == (flat == components)


def test_huge_deviations_are_exact_or_null(spark):
    values = [0.0, 2.0**20, 2.0**31]
    found = whitening.whitened(rows_of(spark, [(i, [v], 0) for i, v in enumerate(values)])).collect()
    x = [int(v * 256) for v in values]
    exact = {i: (3 * v - sum(x)) ** 2 for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in found} == {i: e if e < 2**63 else None for i, e in exact.items()}


def test_whitening_of_nothing(spark):
    assert whitening.whitened(rows_of(spark, [])).count() == 0
    assert whitening.whitened(rows_of(spark, [(1, None, 0), (2, [], 0)])).count() == 0


@needs_tables
def test_whitening_of_the_table(spark):
    rows = [tuple(r)[:3] for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    _, n, _, wanted, _ = expected_whitening(rows)
    found = registry.op11_whitening(spark, FOLDER).orderBy("vec_id", "component").collect()
    made = np.array([r.whitened for r in found]).reshape(-1, 4)
    order = np.argsort([r[0] for r in rows], kind="stable")
    assert np.allclose(np.abs(made), np.abs(wanted[order]), atol=1e-8) and found[0].n == n


# Hard negatives ----------------------------------------------------------------------


@pytest.mark.parametrize("d", [1, 8, 19])
def test_lookups_give_inner_products(d):
    rng = np.random.default_rng(d)
    x, y = rng.integers(-700, 700, (13, d)), rng.integers(-1024, 1023, (50, d))
    y[0], y[1] = -1024, 1023
    table = negatives.subset_sums(x)
    assert (negatives.scores(table, negatives.bit_planes(y, 11)) == y @ x.T).all()


def expected_negatives(rows, anchors):
    d = max(len(v) for _, v, _ in rows[:5])
    seen = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or len(v) != d:
            continue
        if all(c is not None and math.isfinite(c) and abs(c) < 2**32 for c in v):
            one = (label, [math.floor(256 * c) for c in v])
            seen[i] = min(seen.get(i, one), one)
    out = set()
    for a in set(anchors) & set(seen):
        label, x = seen[a]
        score = {i: sum(p * q for p, q in zip(x, y, strict=True)) for i, (_, y) in seen.items()}
        order = sorted(seen, key=lambda i: (-score[i], i))
        for p in [i for i in order if seen[i][0] == label and i != a][:5]:
            hard = [i for i in order if seen[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out |= {(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(hard[:10])}
    return out


@pytest.mark.parametrize(("slice_rows", "anchor_rows"), [(1 << 17, 4096), (7, 5)])
def test_hard_negatives_equal_brute_force(spark, slice_rows, anchor_rows):
    rows = awkward_vectors()
    rows += [(300 + k, rows[k % 4][1], (k // 4) % 3) for k in range(40)]  # ties
    anchors = [0, 1, 2, 3, 40, 40, 200, 201, 105, 106, 999, None]
    frame = rows_of(spark, rows)
    asked = spark.createDataFrame([(a,) for a in anchors], "vec_id long")
    found = negatives.hard_negatives(frame, asked, slice_rows=slice_rows, anchor_rows=anchor_rows)
    wanted = expected_negatives(rows, anchors)
    assert len(wanted) > 100
    made = [tuple(r) for r in found.collect()]
    assert set(made) == wanted and len(made) == len(wanted)


def test_hard_negatives_without_candidates(spark):
    one = spark.createDataFrame([(1,)], "vec_id long")
    none = spark.createDataFrame([], "vec_id long")
    assert negatives.hard_negatives(rows_of(spark, []), one).count() == 0
    assert negatives.hard_negatives(rows_of(spark, [(1, [1.0], 0)]), one).count() == 0
    assert negatives.hard_negatives(rows_of(spark, [(1, [1.0], 0), (2, [1.0], 0)]), none).count() == 0
    only_negative_scores = [(1, [1.0], 0), (2, [-1.0], 0), (3, [-0.5], 1)]
    assert negatives.hard_negatives(rows_of(spark, only_negative_scores), one).count() == 0


@needs_tables
def test_hard_negatives_of_the_table(spark):
    rows = [
        (r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ]
    anchors = [i for i, _, _ in rows if i % 100 == 0]
    found = [
        (r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
        for r in registry.op12_hard_negatives(spark, FOLDER).collect()
    ]
    assert set(found) == expected_negatives(rows, anchors) and found

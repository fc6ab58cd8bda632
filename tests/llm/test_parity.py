"""The n-gram Jaccard join against brute force."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.corpus import FOLDER, HAVE_TABLES, LOWER, SCHEMA, awkward, awkward_rows, empty, words
from tidewarden.llm import bytescan as B
from tidewarden.llm import parity, registry
from tidewarden.llm.near import shingles

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


def shingle_set(text):
    found = words((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + 4]) for k in range(max(1, len(found) - 3)))


def expected(rows):
    """Component and set size per id, for distinct ids that are not null."""
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    for i, s in sets.items():
        common = collections.Counter(j for shingle in s for j in holders[shingle] if j < i)
        for j, both in common.items():
            if both * 100 >= 85 * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def made(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def frame_of(spark, texts):
    return spark.createDataFrame([(i, t, None, None, 0, "", "", "", 0) for i, t in enumerate(texts)], SCHEMA)


# Sketches ----------------------------------------------------------------------------


def sets_of(texts):
    return shingles(*B.utf8(pa.array(texts, pa.string())), 4)


def test_distance_is_at_most_the_symmetric_difference():
    rng = np.random.default_rng(1)
    for size in (3, 40, 900):
        base = rng.integers(0, 1 << 62, size).astype(np.uint64)
        others = [np.unique(np.concatenate((base[: size - k], rng.integers(0, 1 << 62, k).astype(np.uint64)))) for k in range(0, size, max(1, size // 7))]
        base = np.unique(base)
        for each in (parity.COARSE, parity.FINE):
            found = np.concatenate((base, *others))
            offsets = np.concatenate(([0], np.cumsum([len(base), *map(len, others)])))
            table, at = parity.folding_sketches(found, offsets, each)
            sketch = [table[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            length = np.array([len(s) for s in sketch])
            n = len(others)
            far = parity.distances([sketch[0]] * n, sketch[1:], np.repeat(length[0], n), length[1:])
            for other, distance in zip(others, far, strict=True):
                assert distance <= len(np.setxor1d(base, other))
                assert (distance - len(np.setxor1d(base, other))) % 2 == 0


@pytest.mark.parametrize("size", [6, 7, 8, 11, 12, 13, 20, 33, 47, 80, 150, 400, 1200])
def test_similar_sets_share_a_word(size):
    """At the limit of similarity, for sets within and across bands."""
    rng = np.random.default_rng(size)
    for _ in range(60):
        union = rng.choice(1 << 62, size, replace=False).astype(np.uint64)
        most = size * 15 // 100
        left = rng.integers(0, most + 1)
        a, b = np.sort(union[left:]), np.sort(np.concatenate((union[:left], union[left + most - left :])))
        both = len(np.intersect1d(a, b))
        assert both * 100 >= 85 * size
        if len(a) == len(b) == both:
            continue
        found, offsets = np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)])
        keys, owner, beyond = parity.word_keys(found, offsets)
        shared = np.intersect1d(keys[owner == 0], keys[owner == 1])
        assert np.isin(keys[~beyond], shared).any()
        codes = parity.size_codes(np.array([len(a), len(b)])).astype(int)
        assert abs(codes[0] - codes[1]) <= parity.CODES_APART


def test_bands_reach_every_match():
    tops = parity.band_tops(100_000)
    sizes = np.arange(parity.LEAST_SIZE, 100_000)
    furthest = sizes * 100 // 85
    assert (np.searchsorted(tops, furthest) - np.searchsorted(tops, sizes) <= 1).all()


# The join ----------------------------------------------------------------------------


def test_awkward_rows(spark):
    found = parity.jaccard_groups(awkward(spark)).collect()
    rows = [r[:2] for r in awkward_rows()]
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(i for i, _ in rows)
    wanted = expected(rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == wanted[r.doc_id]
    sizes = {(r.n_shingles, r.component_id) for r in found if r.doc_id is None}
    assert sizes == {(0, None), (wanted[1][0], None)}


def test_nothing(spark):
    assert parity.jaccard_groups(empty(spark)).count() == 0


def test_chains_and_short_texts(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = ["a b c", "A b  c", "a b", "a b c d", "a b c d", "", None, "x", "x"]
    for size in (9, 10, 14, 40, 120, 700):
        text = rng.choices(vocabulary, k=size)
        for _ in range(25):  # each step changes a little, so the chain drifts apart
            texts.append(" ".join(text))
            for _ in range(max(1, size // 120)):
                text[rng.randrange(size)] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text.append(rng.choice(vocabulary))
    assert made(parity.jaccard_groups(frame_of(spark, texts))) == expected(list(enumerate(texts)))


@pytest.mark.parametrize(("tile", "hot"), [(1024, 64), (16, 1)])
def test_a_family_near_the_limit(spark, monkeypatch, tile, hot):
    """Texts of one template with so many changes that only some of them link, in small tiles and parts too."""
    monkeypatch.setattr(parity, "TILE", tile)
    monkeypatch.setattr(parity, "HOT", hot)
    monkeypatch.setattr(parity, "SAMPLED", 1 if hot == 1 else 16)
    rng = random.Random(7)
    base = [f"t{i}" for i in range(300)]
    texts = []
    for k in range(400):
        text = list(base)
        for _ in range(rng.randint(1, 9)):
            text[rng.randrange(300)] = f"x{k}-{rng.random()}"
        texts.append(" ".join(text))
    wanted = expected(list(enumerate(texts)))
    components = len({c for _, c in wanted.values()})
    assert 5 < components < 395
    assert made(parity.jaccard_groups(frame_of(spark, texts))) == wanted


def test_very_long_texts(spark):
    words_of = [f"w{i % 5000}-{i // 5000}" for i in range(150_000)]
    near = list(words_of)
    near[::60] = [f"y{i}" for i in range(len(near[::60]))]
    texts = [" ".join(words_of), " ".join(near), "z" * 3_000_000, "q " * 200_000]
    found = made(parity.jaccard_groups(frame_of(spark, texts)))
    assert {i: c for i, (_, c) in found.items()} == {0: 0, 1: 0, 2: 2, 3: 3}
    assert found[2][0] == 1 and found[3][0] == 1


def test_word_hashes_equal_span_hashes():
    rng = np.random.default_rng(0)
    content = rng.integers(32, 40, 5000).astype(np.uint8)
    starts, ends, _ = B.word_bounds(content, np.array([0, 1000, 5000]))
    assert (B.word_hashes(content, starts, ends) == B.span_hashes(content, starts, ends)).all()
    long = np.full(1 << 17, 65, np.uint8)
    at = np.array([0]), np.array([len(long)])
    assert (B.word_hashes(long, *at) == B.span_hashes(long, *at)).all()


@needs_tables
def test_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    wanted = expected(rows)
    assert made(registry.op13_jaccard_join(spark, FOLDER)) == wanted
    assert any(i != c for i, (_, c) in wanted.items())

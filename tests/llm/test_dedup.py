"""Exact and near duplicates, repeated lines and repeated substrings against brute force."""

from __future__ import annotations

import collections
import hashlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import FOLDER, HAVE_TABLES, LOWER, awkward, awkward_rows, empty, words
from tidewarden.llm import exact, lines, near, registry, substrings
from tidewarden.llm import bytescan as B
from tidewarden.llm.common import settled
from tidewarden.llm.links import components
from tidewarden.llm.ordering import repeated_rows
from tidewarden.llm.suffixes import suffix_ranks
from tidewarden.session import shared_folder

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# Exact copies ----------------------------------------------------------------


def expected_copies(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = collections.Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out[i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("run_bits", [0, 4, 8])
def test_exact_copies(spark, run_bits):
    found = exact.exact_copies(awkward(spark), run_bits=run_bits).collect()
    assert collections.Counter(map(tuple, found)) == expected_copies([r[:2] for r in awkward_rows()])


def test_exact_copies_can_keep_the_smallest(spark):
    found = exact.exact_copies(awkward(spark), keep="smallest").where("kept").collect()
    assert {r.doc_id for r in found} >= {1, 8} and 4 in {r.doc_id for r in found}


def test_dropping_exact_copies_keeps_columns_and_one_row_each(spark):
    docs = awkward(spark)
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns
    texts = [(r.text or "").translate(LOWER) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({(r[1] or "").translate(LOWER) for r in awkward_rows()})


def test_exact_copies_of_nothing(spark):
    assert exact.exact_copies(empty(spark)).count() == 0 == exact.drop_exact_copies(empty(spark)).count()


# Near copies -----------------------------------------------------------------


def shingle_set(text):
    found = words((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4)))


def expected_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    homes = collections.defaultdict(list)
    for i in sorted(sets):
        meets = collections.Counter()
        for s in sets[i]:
            meets.update(homes[s])
            homes[s].append(i)
        for j, n in meets.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows(n=60):
    """A base text with more and more words changed, and short texts."""
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(n):
        text = list(base)
        for k in range(i % 12):
            text[(17 * k + i) % 200] = f"c{i}x{k}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(f"s{j}" for j in range(i))) for i in range(1, 12)]
    return rows


def test_near_groups_match_all_pairs(spark):
    rows = near_rows()
    found = near.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = expected_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@needs_tables
def test_near_groups_of_documents(spark):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    found = registry.QUERIES["op9_near_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows)


def test_near_groups_of_awkward_rows(spark):
    found = near.near_groups(awkward(spark)).collect()
    assert len(found) == len(awkward_rows())
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 8, 9)] == [1, 1, 1, 1, 8, 8]
    assert all(by_id[i].n_shingles == 0 and by_id[i].component_id == i for i in (5, 6, 7))
    left = near.drop_near_copies(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert {2, 3, 4, 9}.isdisjoint({r.doc_id for r in left.collect()})
    assert near.near_groups(empty(spark)).count() == 0 == near.drop_near_copies(empty(spark)).count()


def family(n=2000, length=604, changes=11):
    """One template with changed words: most pairs lie just below the limit, few above it."""
    draw = np.random.default_rng(11)
    changed = np.zeros((n, length), bool)
    rows = []
    for i in range(n):
        changed[i, draw.choice(length, changes, replace=False)] = True
        rows.append((i, " ".join(f"c{i}x{k}" if c else f"b{k}" for k, c in enumerate(changed[i]))))
    whole = ~np.lib.stride_tricks.sliding_window_view(changed, 5, axis=1).any(axis=2)
    both = (whole.astype(np.float32) @ whole.T.astype(np.float32)).astype(np.int64)
    left, right = np.nonzero(np.triu(100 * both >= 75 * (2 * (length - 4) - both), 1))
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, left, label[right])
        np.minimum.at(least, right, label[left])
        if (least == label).all():
            return rows, label.tolist()
        label = least


def test_a_family_near_the_limit_is_linked_whole(spark):
    rows, expected = family()
    found = near.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(expected))


def test_a_crowded_tile_gives_its_classes_and_not_their_pairs():
    base = [f"b{k}" for k in range(300)]
    texts = [" ".join(f"c{i}x{k}" if k in (7 * i % 300, 150) else w for k, w in enumerate(base)) for i in range(80)]
    found, offsets = near.shingles(*B.utf8(pa.array(texts)))
    sketch = near.registers(found, offsets)
    keys, _ = near.band_keys(sketch)
    key = collections.Counter(keys[:, 0]).most_common(1)[0][0]
    ids = np.tile(np.arange(80), 2)
    tile = pa.table({
        "key": pa.array(np.full(160, key).view(np.int64)), "i": pa.array([0] * 160, pa.int32()), "j": pa.array([0] * 160, pa.int32()),
        "side": pa.array(np.repeat([0, 1], 80).astype(np.int32)), "class_id": ids, "component": ids, "outside": [True] * 160,
        "n_shingles": np.diff(offsets)[ids], "sketch": pa.array([sketch[i].tobytes() for i in ids], pa.binary()),
    })
    pairs = [(ids[r], ids[n]) for r, c in near._tile_pairs(tile) for n in c]
    rows = near._tile_rows(tile)
    assert len(pairs) > 300 > 160 >= rows.num_rows and rows.column("b").null_count == rows.num_rows
    assert set(rows.column("a").to_pylist()) == {int(i) for p in pairs for i in p}
    sets = pa.array([found[offsets[i] : offsets[i + 1]].view(np.int64) for i in rows.column("a").to_pylist()])
    linked = near._tile_links(rows.rename_columns(["class_id" if c == "a" else c for c in rows.column_names]).append_column("set", sets))
    expected = {frozenset(p) for p in pairs if expected_components([(i, texts[i]) for i in p])[max(p)][1] == min(p)}
    got = {frozenset(p) for p in zip(linked.column("a").to_pylist(), linked.column("b").to_pylist(), strict=True)}
    assert got <= expected and len(got) < 80

    def parts(links):
        label = list(range(80))
        for _ in range(80):
            for a, b in map(tuple, links):
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert parts(got) == parts(expected)


def test_texts_are_picked_and_cut_by_one_worker(spark):
    docs = spark.createDataFrame(near_rows(5), "class_id long, text string")
    sets = near._sets_of(docs, docs.where("class_id < 3").select("class_id"))
    assert sets._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {0, 1, 2} <= {r.class_id for r in sets.collect()}


def test_estimates_are_close_and_corrected():
    draw = np.random.default_rng(1)
    pool = draw.integers(1, 1 << 63, 4000).astype(np.uint64)
    for shared in (0, 1000, 1800):
        a, b = np.unique(pool[:2000]), np.unique(pool[2000 - shared : 4000 - shared])
        sketch = near.registers(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
        size = np.array([2000.0])
        score, error = near.estimate(sketch[:1], sketch[1:], size, size)
        true = shared / (4000 - shared)
        assert abs(score[0] - true) < 5 * max(error[0], 0.01)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    links = spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


# Repeated lines --------------------------------------------------------------


def expected_lines(rows, least=5):
    seen, out = set(), {}
    for doc_id, text in rows:
        kept, spans, at = [], [], 0
        for line in (text or "").split("\n"):
            key = tuple(words(line.translate(LOWER)))
            if len(key) >= least and key in seen:
                spans.append(f"{at}:{at + len(line)}")
            else:
                seen.add(key)
                kept.append(line)
            at += len(line) + 1
        out[doc_id] = (",".join(spans), "\n".join(kept))
    return out


def test_repeated_lines(spark):
    rows = [
        (1, "this line has five words\nshort\nother text of six words here"),
        (2, "THIS  line has\tfive words \nshort\nlast one"),
        (3, "keep\nthis line has five words"),
        (4, "this line has five words"),
        (5, None),
        (6, ""),
    ]
    found = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.spans, r.text) for r in found} == expected_lines(rows)


def test_repeated_lines_of_awkward_rows(spark):
    found = lines.drop_repeated_lines(awkward(spark)).collect()
    assert len(found) == len(awkward_rows())
    long_lines = [r for r in found if r.text and r.text.startswith("word0x0")]
    assert len(long_lines) == 2  # one of the equal lines, and the one with a tail
    assert lines.drop_repeated_lines(empty(spark)).count() == 0


# Repeated substrings ---------------------------------------------------------


def expected_substrings(rows, length=400):
    counts = collections.Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        counts.update(raw[k : k + length] for k in range(len(raw) - length + 1))
    out = collections.Counter()
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if counts[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def passages(seed=3):
    """Passages of every length around the limit in differing surroundings."""
    draw = np.random.default_rng(seed)

    def text(n):
        return "".join(draw.choice(list("abcdefgh ijklé"), n))

    shared = [text(n) for n in (380, 390, 398, 399, 400, 401, 420, 700, 1500)]
    rows = []
    for i in range(40):
        parts = [text(int(draw.integers(0, 300)))]
        for p in draw.choice(len(shared), 2):
            cut = int(draw.integers(0, 60)) if i % 3 == 0 else 0
            parts += [shared[p][cut:], text(int(draw.integers(0, 200)))]
        rows.append((i, "".join(parts)))
    rows += [(50, "ab" * 600), (51, "z" * 900), (52, rows[0][1]), (53, None), (54, "")]
    return rows


@pytest.mark.parametrize("seed", [3, 4])
def test_repeated_substrings(spark, seed):
    rows = passages(seed)
    found = substrings.drop_repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter(map(tuple, found)) == expected_substrings(rows)


def test_repeated_substrings_of_awkward_rows(spark):
    rows = [r[:2] for r in awkward_rows() if r[0] != 14]
    docs = awkward(spark).where("doc_id IS NULL OR doc_id <> 14")
    found = substrings.drop_repeated_substrings(docs).collect()
    assert collections.Counter(map(tuple, found)) == expected_substrings(rows)
    assert substrings.drop_repeated_substrings(empty(spark)).count() == 0


def test_suffix_ranks_sort_suffixes(spark):
    draw = np.random.default_rng(5)
    strings = [draw.integers(0, 4, int(n)).tolist() for n in draw.integers(1, 40, 12)]
    frame = spark.createDataFrame(list(enumerate(strings)), "sid long, symbols array<long>")
    found = sorted((r["rank"], r.sid, r.j) for r in suffix_ranks(frame, 100).collect())

    def suffix(sid, j):
        rest = strings[sid][j:]
        return rest[: rest.index(0)] if 0 in rest else rest

    ordered = [suffix(sid, j) for _, sid, j in found]
    assert len(ordered) == sum(1 for s in strings for x in s if x)
    assert ordered == sorted(ordered)


def test_equal_strings_are_cut_alike():
    draw = np.random.default_rng(6)
    core = draw.integers(97, 120, 1000).astype(np.uint8)
    texts = [np.concatenate((draw.integers(97, 120, n).astype(np.uint8), core, draw.integers(97, 120, 300).astype(np.uint8))) for n in (0, 37, 500)]
    cuts = []
    for n, text in zip((0, 37, 500), texts, strict=True):
        at, _ = substrings.cuts_of(text, np.array([0, len(text)]))
        cuts.append({int(c) - n for c in at if n + substrings.WINDOW <= c <= n + 1000 - substrings.WINDOW - substrings.GRAM})
    assert cuts[0] == cuts[1] == cuts[2] and cuts[0]


def test_span_hashes_depend_on_the_bytes_alone():
    content = np.frombuffer(b"abcabcabd", np.uint8)
    h = B.span_hashes(content, np.array([0, 3, 6]), np.array([3, 6, 9]))
    assert h[0] == h[1] != h[2]


def test_every_window_belongs_to_one_anchor_and_equal_windows_to_anchors_at_equal_distance():
    texts = [t.encode() for _, t in passages() if t]
    content, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    at, rows, first, last = substrings.owners_of(content, bounds)
    last = np.minimum(last, bounds[rows + 1] - substrings.LENGTH)
    owned, distances = [], collections.defaultdict(set)
    for a, row, low, high in zip(at, rows, first, last, strict=True):
        for start in range(low, high + 1):
            assert a - substrings.WINDOW < start <= a and a + substrings.CORE <= start + substrings.LENGTH
            owned.append(start)
            distances[content[start : start + substrings.LENGTH].tobytes()].add(a - start)
    every = [s for a, b in zip(bounds[:-1], bounds[1:], strict=True) for s in range(a, b - substrings.LENGTH + 1)]
    assert owned == every and all(len(d) == 1 for d in distances.values()) and len(distances) < len(owned)


def test_hashes_of_spans_in_long_texts_equal_those_of_a_whole(monkeypatch):
    draw = np.random.default_rng(8)
    content = draw.integers(97, 120, 5000).astype(np.uint8)
    starts = np.sort(draw.integers(0, 4400, 300))
    ends = starts + draw.integers(1, 560, 300)
    monkeypatch.setattr(substrings, "SEGMENT", 700)
    assert (substrings._hashes(content, starts, ends) == B.span_hashes(content, starts, ends)).all()


@pytest.mark.parametrize("weighted", [False, True])
def test_repeated_rows_of_rare_and_hot_keys(spark, weighted):
    draw = np.random.default_rng(9)
    rows = [(int(k), int(s), 1) for k, s in zip(draw.integers(0, 300, 400), draw.integers(0, 50, 400), strict=True)]
    rows += [(1000, s, 1) for s in range(700)] + [(1001, 5, 1)] * 2 + [(1002, 5, 2), (1003, 5, 1), (None, 5, 1), (None, 6, 1)]
    frame = spark.createDataFrame(rows, "k long, s long, w long")
    sums = collections.Counter()
    for k, _, w in rows:
        sums[k] += w if weighted else 1
    found = repeated_rows(frame, ["k"], F.col("s"), F.col("w") if weighted else None)
    assert collections.Counter(map(tuple, found.collect())) == collections.Counter(r for r in rows if r[0] is not None and sums[r[0]] > 1)


def test_the_check_of_ends_writes_windows_of_unlike_places_only(spark, monkeypatch):
    """Near copies in which every text has its own word: what is written for windows stays below a row per byte, and no table is left but the result."""
    draw = np.random.default_rng(10)
    base = "".join(draw.choice(list("abcdefgh ijkl"), 3000))
    rows = [(i, base[: 50 * i + 20] + f"<{i}>" + base[50 * i + 20 :]) for i in range(30)]
    counts = {}

    def counted(frame, label, **options):
        made = settled(frame, label, **options)
        counts[label] = made.count()
        return made

    monkeypatch.setattr(substrings, "settled", counted)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    found = substrings.drop_repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter(map(tuple, found)) == expected_substrings(rows)
    assert 0 < counts["substring-windows"] < 30 * 1000 and "substring-contexts" not in counts
    assert [f.name.rsplit("-", 1)[0] for f in set(folder.iterdir()) - before] == ["substring-removed"]

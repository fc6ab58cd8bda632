"""Quality, toxicity, personal data and language: base values by brute force, the rest held out."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.corpus import FOLDER, HAVE_TABLES, awkward, awkward_rows, empty, labels, words
from tidewarden.llm import language, personal, quality, registry, toxicity

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


# Quality ---------------------------------------------------------------------


def expected_base(text):
    found = words(text)
    chars = sum(map(len, found))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    windows = {}
    for k in range(len(found) - 7):
        windows.setdefault(tuple(found[k : k + 8]), []).append(k)
    inside = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    failed = len(found) < 20 or 100 * len(inside) > 30 * len(found)
    return len(found), chars, symbols, dups, len(inside), failed


def test_rule_statistics_of_awkward_rows(spark):
    rows = quality.quality_verdicts(awkward(spark), labels(spark)).collect()
    found = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert found == sorted((r[0] or -1, *expected_base(r[1])) for r in awkward_rows())
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert quality.quality_verdicts(empty(spark), labels(spark)).count() == 0


@needs_tables
def test_quality_of_documents(spark):
    expected = {d.doc_id: expected_base(d.text) for d in documents(spark)}
    rows = registry.QUERIES["op2_quality"](spark, FOLDER).collect()
    assert {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows
    } == expected
    assert all(not (r.kept and r.base_failed) for r in rows)
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [r.kept for r in rows if known.get(r.doc_id) == 1]
    assert np.mean(good) > 0.9


def test_forest_sets_outliers_apart():
    draw = np.random.default_rng(1)
    plain = draw.normal(size=(2000, 3))
    forest = quality.Forest(plain)
    assert forest.score(np.full((1, 3), 9.0))[0] > np.quantile(forest.score(plain), 0.99)
    assert quality.Forest(plain[:1]).score(plain[:2]).shape == (2,)


# Toxicity --------------------------------------------------------------------


def test_search_is_exact():
    draw = random.Random(1)
    terms = [f"t{i}".encode() for i in range(80)]
    index = toxicity.Index(terms, np.array([1.0 + draw.random() for _ in terms]))
    rows = []
    for i in range(400):
        chosen = draw.choices(terms[: 1 + draw.randrange(80)], k=draw.randint(1, 12))
        numbers, weights = index.vector(chosen)
        rows.append((i, draw.randrange(2), numbers.tolist(), weights.tolist()))
    index.build(rows, (1.0, 1.0))
    dense = np.zeros((len(rows), len(terms)))
    place = {i: n for n, i in enumerate(index.ids)}
    for i, _, numbers, weights in rows:
        dense[place[i], numbers] = weights
    for _ in range(100):
        numbers, weights = index.vector(draw.choices(terms, k=draw.randint(1, 8)))
        query = np.zeros(len(terms))
        query[numbers] = weights
        exact = np.sort(dense @ query)[::-1]
        _, found = index.nearest(numbers, weights, 15)
        expected = exact[exact > 0][:15]
        assert np.allclose(found[: len(expected)], expected)


def toxic_corpus(n=400):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(n):
        text = [draw.choice(vocabulary) for _ in range(60)]
        bad = i % 5 == 1
        if bad:
            text[10:12] = [draw.choice(["nasty", "vile", "rotten"]), draw.choice(["nasty", "vile", "rotten"])]
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_held_out_toxicity(spark):
    rows, marks = toxic_corpus()
    found = toxicity.toxicity_scores(spark.createDataFrame(rows, "doc_id long, text string"), labels(spark, marks)).collect()
    truth = {i: t for i, _, t in marks}
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert any(r.evidence and r.evidence[0].toxic == 1 for r in held if r.predicted)


def test_toxicity_of_awkward_rows(spark):
    rows, marks = toxic_corpus(100)
    assert toxicity.toxicity_scores(awkward(spark), labels(spark)).count() == len(awkward_rows())
    assert toxicity.toxicity_scores(awkward(spark), labels(spark, [(1, 1, 1), (1, 1, 0), (None, 1, 1), (4, None, None)])).count() == len(awkward_rows())
    left = toxicity.drop_toxic(awkward(spark), labels(spark, marks))
    assert left.columns == awkward(spark).columns and left.count() == len(awkward_rows())
    assert toxicity.toxicity_scores(empty(spark), labels(spark)).count() == 0


# Personal data ---------------------------------------------------------------

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def expected_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                doubled = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or doubled % 10:
                    continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_match_the_patterns():
    draw = random.Random(1)
    for alphabet, n in (("ab@@@...%_-+ ()0123456789é", 20_000), ("0123456789 -.", 10_000), ("0123456789+() ", 5_000)):
        for _ in range(n):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 45)))
            assert personal.base_spans(text) == expected_spans(text)


def test_long_runs_take_linear_time():
    text = "a" * 200_000 + "1" * 200_000 + "." * 1000 + "((" * 50_000
    assert personal.base_spans(text) == []


def written(spans):
    return ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_personal_data_of_awkward_rows(spark):
    rows = personal.personal_spans(awkward(spark)).collect()
    found = sorted((r.doc_id or -1, r.base_sha256) for r in rows)
    assert found == sorted(
        (r[0] or -1, hashlib.sha256(written(expected_spans(r[1] or "")).encode()).hexdigest()) for r in awkward_rows()
    )
    assert personal.personal_spans(empty(spark)).count() == 0


@needs_tables
def test_personal_data_of_documents(spark):
    expected = {d.doc_id: expected_spans(d.text or "") for d in documents(spark)}
    for r in registry.QUERIES["op4_personal_data"](spark, FOLDER).collect():
        spans = expected[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert r.base_sha256 == hashlib.sha256(written(spans).encode()).hexdigest()
        assert set(filter(None, written(spans).split(","))) <= set(r.spans.split(","))


def test_sure_contexts_discover_unseen_numbers(spark):
    rows = [(i, f"please phone me on +1 389 555 {5000 + i} today or later") for i in range(40)]
    rows += [(100, "please phone me on 389 555 7777 today or later"), (101, "there were 389 555 7778 grains of sand")]
    found = {r.doc_id: r for r in personal.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100].n_added == 1 and found[100].spans == "phone:19:31" and found[100].n_phone == 0
    assert found[101].n_added == 0


def test_open_candidates_do_not_count_against_a_context(spark):
    """A third of the numbers of one context are unseen; another context holds addresses as well."""
    rows = [(i, f"please phone me on +1 389 555 {5000 + i} today or later") for i in range(20)]
    rows += [(100 + i, f"please phone me on 389 555 {7000 + i} today or later") for i in range(10)]
    rows += [(200 + i, f"see entry for +1 389 556 {5000 + i} below") for i in range(20)]
    rows += [(300 + i, f"see entry for 10.0.0.{i} below") for i in range(10)]
    rows += [(400, "see entry for 389 556 7777 below")]
    found = {r.doc_id: r for r in personal.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[100 + i].spans == "phone:19:31" and found[100 + i].n_added == 1 for i in range(10))
    assert found[400].n_added == 0


# Language --------------------------------------------------------------------


@needs_tables
def test_held_out_languages(spark):
    truth = {d.doc_id: d.lang for d in documents(spark)}
    rows = registry.QUERIES["op10_language"](spark, FOLDER).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_awkward_rows(spark):
    rows = language.languages(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows())
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (5, 6, 7))
    assert by_id[1].lang_pred in ("en", "de")
    assert language.languages(empty(spark)).count() == 0
    nothing = awkward(spark).withColumn("lang", __import__("pyspark").sql.functions.lit(None).cast("string"))
    assert {r.lang_pred for r in language.languages(nothing).collect()} == {"und"}


def test_filter_holds_every_entry_and_few_others():
    draw = np.random.default_rng(2)
    grams = np.unique(draw.integers(1, 1 << 62, 5000).astype(np.uint64))
    masks = (draw.integers(1, 8, len(grams)).astype(np.uint64))[:, None]
    made = language.Filter(["a", "b", "c"], grams, masks, np.ones(3))
    assert ((made.languages_of(grams)[0] & masks[:, 0]) == masks[:, 0]).all()
    others = draw.integers(1 << 62, 1 << 63, 5000).astype(np.uint64)
    rate = np.mean([(made.languages_of(others)[0] >> np.uint64(i) & np.uint64(1)).mean() for i in range(3)])
    assert rate < 0.01 and abs(rate - made.false_rate.mean()) < 0.01

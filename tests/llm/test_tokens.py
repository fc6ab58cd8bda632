"""Piece encoding against the library and a full search, and mixing against its definition."""

from __future__ import annotations

import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import FOLDER, HAVE_TABLES, awkward, awkward_rows, empty, words
from tidewarden.llm import mixing, pieces, registry

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("sentencepiece")
    return pieces.Vocabulary.load()


def ids(vocabulary, text):
    return np.frombuffer(vocabulary.encode(text), np.int32)


def samples():
    draw = random.Random(2)
    parts = ["a", "b", "in", "the", " ", "  ", "\n", "é", "ing", "-", "0", "日", "本", "🙂", "==", "    ", "st"]
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(500)]
    return [*made, "qwertyuiopasdfghjkl" * 90 + "thequickbrown" * 50, "ñ" * 300, " " * 100]


def test_ids_are_those_of_the_library(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for text in samples():
        assert ids(vocabulary, text).tolist() == model.encode(text)


def test_every_text_comes_back(vocabulary):
    for text in [*samples(), "▁", "a▁ ▁b", "\0x", "<s> <0x41>"]:
        assert vocabulary.decode(ids(vocabulary, text)) == text


def test_streaming_unigram_search_equals_a_full_one():
    draw = random.Random(3)
    letters = "abc"
    scores = {c: -5.0 for c in letters} | {
        "".join(draw.choice(letters) for _ in range(draw.randint(2, 4))): -draw.randint(1, 90) / 8 for _ in range(25)
    }
    numbers = {p: i for i, p in enumerate(scores)}
    made = pieces.Vocabulary(scores, numbers, [], list(range(1000, 1256)), merges=False)

    def best(text):
        table = [(0.0, 0)] + [(-1e300, 0)] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - 4), end):
                s = scores.get(text[start:end])
                if s is not None and table[start][0] + s > table[end][0]:
                    table[end] = (table[start][0] + s, start)
        return table[-1][0]

    for _ in range(60):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 200)))
        found = [list(scores)[i] for i in made.stream(text)]
        assert "".join(found) == text
        assert sum(scores[p] for p in found) == pytest.approx(best(text))


def test_encoding_awkward_rows(spark):
    rows = pieces.encoded(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows()) and all(r.round_trip for r in rows)
    assert all(r.n_ids == len(r.ids) for r in rows)
    assert {r.n_ids for r in rows if r.doc_id in (5, 6)} == {0}
    back = {r.doc_id: r.text for r in pieces.decoded(pieces.encoded(awkward(spark))).collect()}
    assert all(back[r[0]] == (r[1] or "") for r in awkward_rows() if r[0] is not None)
    assert pieces.encoded(empty(spark)).count() == 0


# Mixing ----------------------------------------------------------------------


def expected_targets(sizes):
    """Fixpoint of sharing by weight and stopping at twice the size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    stopped, left = {}, 1.5 * sum(sizes.values())
    free = set(order)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 2 * sizes[s]}
        if not over:
            return stopped | {s: unit * weight[s] for s in free}
        for s in over:
            stopped[s] = 2.0 * sizes[s]
            left -= stopped[s]
        free -= over
    return stopped


def check_mix(rows, sources):
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        key = sources[r.doc_id]
        size, taken = by_source.get(key, (0, 0))
        by_source[key] = (size + r.size, taken + r.taken)
        assert r.source_size >= r.size
    targets = expected_targets({s: v[0] for s, v in by_source.items()})
    for r in rows:
        assert r.target == pytest.approx(targets[sources[r.doc_id]])
        assert r.source_size == by_source[sources[r.doc_id]][0]
    for s, (_, taken) in by_source.items():
        assert abs(taken - targets[s]) <= 0.5001


@needs_tables
def test_mix_of_documents(spark):
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = registry.QUERIES["op1_source_mix"](spark, FOLDER).collect()
    assert len(rows) == len(sources)
    check_mix(rows, sources)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, registry.QUERIES["op1_source_mix"](spark, FOLDER).collect()))


@pytest.mark.parametrize("block_words", [1, 7, 128])
def test_mix_for_any_block_length(spark, block_words):
    data = [(i, "w " * (i * 7 % 90), ["b", "a", None, "c"][i % 4]) for i in range(80)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = mixing.mixed_words(docs, block_words=block_words, chunks=3).collect()
    check_mix(rows, {i: s for i, _, s in data})


def test_mix_blocks_hold_what_is_taken(spark):
    data = [(i, "w " * (i * 5 % 60), f"s{i % 3}") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    taken = {r.doc_id: r.taken for r in mixing.mixed_words(docs, block_words=16).collect()}
    blocks = mixing.mix_blocks(docs, block_words=16).collect()
    summed = {}
    for b in blocks:
        assert 0 <= b.first_word < b.end_word <= 5 * b.doc_id % 60
        summed[b.doc_id] = summed.get(b.doc_id, 0) + b.end_word - b.first_word
    assert summed == {i: n for i, n in taken.items() if n}


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100, 1000):
        frame = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(9)).alias("p"))
        assert sorted(r.p for r in frame.collect()) == list(range(n))


def test_mix_of_awkward_rows(spark):
    rows = mixing.mixed_words(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows())
    assert sorted(r["size"] for r in rows) == sorted(len(words(r[1])) for r in awkward_rows())
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    copies = mixing.mix_documents(awkward(spark))
    assert copies.columns == awkward(spark).columns and copies.count() > 0
    assert mixing.mixed_words(empty(spark)).count() == 0 == mixing.mix_documents(empty(spark)).count()


def test_segments_met_once_take_no_room(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "SEGMENTS", 50)
    fresh = pickle.loads(pickle.dumps(pieces.Vocabulary.load(sparing=True)))
    once, often = [f"wq{k:04d}x".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(400)], ["the", "qwzjxk"]
    for word in once:
        assert fresh.encode(f"{word} the qwzjxk") == vocabulary.encode(f"{word} the qwzjxk")
    known = fresh.remembered.keys() | fresh.older.keys()
    assert {f" {w}" for w in often} <= known and len(known & {f" {w}" for w in once}) < 10


def test_texts_that_do_not_come_back_are_told(vocabulary):
    fresh = pickle.loads(pickle.dumps(vocabulary))
    ids = fresh.encode("the end")
    assert fresh.returns("the end", ids)
    fresh.contents = [b" wrong" if c == b" cat" else c for c in fresh.contents]
    assert not fresh.returns("the cat", fresh.encode("the cat")) and fresh.returns("the end", ids)


def test_the_search_meets_only_pieces_that_end_where_it_looks():
    pieces_of = {p: -float(k) for k, p in enumerate(["a", "b", "c", "ab", "bc", "abc", "cab", "xabc", "bcab"])}
    root = pieces._automaton(pieces_of)
    draw = np.random.default_rng(5)
    for _ in range(50):
        text, node = "".join(draw.choice(list("abcxy"), 30)), root
        for end in range(1, 31):
            while text[end - 1] not in node[0] and node[2] is not None:
                node = node[2]
            node = node[0].get(text[end - 1], node)
            expected = [text[s:end] for s in range(end - 1) if text[s:end] in pieces_of]
            assert [piece for _, piece in node[1]] == expected

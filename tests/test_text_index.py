"""The text index of the store, and counts from footers."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.operators.search import match_events, storage_summary
from tidewarden.sources import store, text_index

LATER = T0 + dt.timedelta(hours=1)


@pytest.mark.parametrize(("text", "stretches"), [
    ("abc", ["abc"]), ("a%bc_d", ["a", "bc", "d"]), ("%_%", []), ("", []),
    (r"a\%b%c", ["a%b", "c"]), (r"a\_b\\c", [r"a_b\c"]), ("tail\\", ["tail\\"]),
])
def test_patterns_are_cut_at_wildcards(text, stretches):
    assert text_index.fixed_stretches(text) == stretches


def test_grams_are_few_and_the_same_every_time():
    assert text_index.grams_of("ab%cd") == []
    assert text_index.grams_of("abcd_xyz") == ["abc", "bcd", "xyz"]
    long = "".join(chr(200 + i % 500) for i in range(900))
    assert len(text_index.grams_of(long)) <= text_index.MOST_GRAMS and text_index.grams_of(long) == text_index.grams_of(long)
    assert text_index.grams_of("a🙂bcd") == ["bcd"]


WORDS = ["alpha", "beta", "gamma", "delta", "größe", "🙂smile", "100%", "under_score"]


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """Eight batches, one word each; the last one is not indexed."""
    from tidewarden.schemas import TELEMETRY_EVENT

    root = str(tmp_path_factory.mktemp("store"))
    for number, word in enumerate(WORDS):
        rows = [
            (f"e{number}-{i}", "s", "log", "x", f'{{"message": "{word} {i}"}}', T0 + dt.timedelta(days=i), None, {"w": word.upper()})
            for i in range(2)
        ]
        rows.append((f"empty{number}", "s", "log", None, None, T0, None, None))
        if number == len(WORDS) - 1:
            assert text_index.update_index(spark, root) == 2 * number
        store.write_batch(spark.createDataFrame(rows, TELEMETRY_EVENT), root, number, F.lit(T0))
    return root


@pytest.mark.parametrize(("text", "files"), [
    ("alpha", 2 + 2), ("ALPHA", 2 + 2), ("lph_ 1", 2 + 2), ("alpha%beta", 2), ("et", 16), ("%", 16), ("größe", 2 + 2),
    ("smile", 2 + 2), (r"100\% 0", 2 + 2), ("100%", 2 + 2), ("under_score", 2), ("nowhere", 2), ("message", 16), ('"w":"BETA"', 2 + 2),
])
def test_only_files_that_can_match_are_opened(spark, filled, text, files):
    opened = text_index.files_for(spark, filled, text)
    assert opened.stored == 16
    # one file may lack the grams of a number, never more than ``files`` are opened
    assert len(opened.files) <= files and len(opened.files) >= min(files, 2)
    found = text_index.indexed_matches(spark, filled, text)
    wanted = match_events(store.read_events(spark, filled), text=text)
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in wanted.collect())


def test_other_filters_apply(spark, filled):
    found = text_index.indexed_matches(spark, filled, "alpha", start=F.lit(T0 + dt.timedelta(hours=1)))
    assert [r.id for r in found.collect()] == ["e0-1"]


def test_the_row_that_stands_decides(spark, make_events, tmp_path):
    root = str(tmp_path / "store")
    rows = [{"id": "a", "type": "log", "payload": "needle old"}, {"id": "b", "type": "log", "payload": "needle stays"}]
    store.write_batch(make_events(*rows), root, 0, F.lit(T0))
    store.write_batch(make_events({"id": "a", "type": "log", "payload": "changed"}, {"id": "c", "type": "log", "payload": "old needle"}), root, 1, F.lit(LATER))
    store.write_batch(make_events({"id": "c", "type": "log", "payload": "new needle"}), root, 2, F.lit(LATER + dt.timedelta(hours=1)))
    assert text_index.update_index(spark, root) == 3 and text_index.update_index(spark, root) == 0
    found = text_index.indexed_matches(spark, root, "needle").collect()
    assert {(r.id, r.payload) for r in found} == {("b", "needle stays"), ("c", "new needle")}


def test_compacted_days_are_indexed_anew(spark, make_events, tmp_path):
    root = str(tmp_path / "store")
    for number in range(3):
        store.write_batch(make_events({"id": f"e{number}", "type": "log", "payload": f"word{number}"}), root, number, F.lit(T0))
    text_index.update_index(spark, root)
    store.compact(spark, root, up_to=1, least_batches=2)
    assert text_index.files_for(spark, root, "word0").stored == 2
    assert [r.id for r in text_index.indexed_matches(spark, root, "word0").collect()] == ["e0"]
    assert text_index.update_index(spark, root) == 1
    opened = text_index.files_for(spark, root, "word2")
    assert len(opened.files) == 1 and "batch=2" in opened.files[0]
    assert [r.id for r in text_index.indexed_matches(spark, root, "word").orderBy("id").collect()] == ["e0", "e1", "e2"]


def test_an_empty_store_has_no_matches(spark, tmp_path):
    root = str(tmp_path / "none")
    assert text_index.update_index(spark, root) == 0
    assert text_index.indexed_matches(spark, root, "word").count() == 0


def test_a_summary_reads_footers_and_the_last_days_only(spark, filled):
    events = store.read_events(spark, filled, every_copy=True)
    points = store.read_points(spark, filled, every_copy=True)
    summary = storage_summary(events, points, F.lit(T0 + dt.timedelta(days=1, minutes=30)))
    assert tuple(summary.first()) == (24, 0, 8, 0)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    schemas = sorted(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    # the points of this store are empty, so their day is no folder yet
    assert schemas == ["", "", "time:timestamp,event_date:date", "ts:timestamp"]
    assert "PartitionFilters: [isnotnull(event_date" in plan

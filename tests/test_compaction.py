"""Compaction of stored days behind a manifest."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.schemas import TELEMETRY_EVENT
from tidewarden.sources import compaction, store
from tidewarden.streaming import streams

LATER = T0 + dt.timedelta(hours=1)


def batch_of(make_events, number, rows=4):
    return make_events(*[
        {"id": f"e{number}-{i}", "at": 86_400 * (i % 2) + i, "payload": f'{{"metric": "m", "value": {i}}}'}
        for i in range(rows)
    ])


def state(spark, root):
    events, points = store.read_events(spark, root), store.read_points(spark, root)
    return sorted((r.id, r.subtype, r.ts) for r in events.collect()), sorted((r.id, r.value) for r in points.collect())


@pytest.fixture
def filled(spark, make_events, tmp_path):
    root = str(tmp_path / "store")
    for number in range(5):
        store.write_batch(batch_of(make_events, number), root, number, F.lit(T0))
    return root


def files(root, pattern):
    return sorted(Path(root).glob(pattern))


def test_reading_gives_the_same_rows_before_during_and_after(spark, make_events, filled, monkeypatch):
    before = state(spark, filled)
    # a compaction that dies after writing its folder, before the manifest
    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(compaction, "_enter", lost)
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact_days(spark, f"{filled}/events", store.EVENT_ROWS, 3, ["ts"], 2)
    assert files(filled, "events-compacted/version=1/event_date=*")
    assert state(spark, filled) == before
    store.compact(spark, filled, up_to=3, least_batches=2)
    assert state(spark, filled) == before
    assert len(files(filled, "events-compacted/version=1/event_date=*/*.parquet")) == 2  # one per day
    compaction.drop_covered(spark, f"{filled}/events", store.EVENT_ROWS)
    compaction.drop_covered(spark, f"{filled}/points", store.METRIC_POINT)
    assert [p.name for p in files(filled, "events/event_date=*/batch=*")] == ["batch=4", "batch=4"]
    assert state(spark, filled) == before


def test_a_retried_batch_stays_idempotent_after_its_compaction(spark, make_events, filled):
    store.compact(spark, filled, up_to=3, least_batches=2)
    before = state(spark, filled)
    store.write_batch(batch_of(make_events, 2), filled, 2, F.lit(LATER))
    assert state(spark, filled) == before
    assert store.read_events(spark, filled, every_copy=True).count() == 20


def test_later_versions_take_over_and_replace(spark, make_events, filled):
    store.compact(spark, filled, up_to=2, least_batches=2)
    # an update of a compacted row, on the same day
    changed = batch_of(make_events, 1).withColumn("subtype", F.lit("new"))
    store.write_batch(changed, filled, 5, F.lit(LATER))
    store.compact(spark, filled, up_to=5, least_batches=2)
    known = compaction.manifest(spark, f"{filled}/events")
    assert set(known.version.values()) == {2} and set(known.up_to.values()) == {5}
    rows = state(spark, filled)[0]
    assert {(i, s) for i, s, _ in rows if i.startswith("e1-")} == {(f"e1-{k}", "new") for k in range(4)} and len(rows) == 20
    compaction.drop_covered(spark, f"{filled}/events", store.EVENT_ROWS)
    assert files(filled, "events-compacted/version=1/event_date=*") == [] == files(filled, "events/event_date=*/batch=*")
    assert state(spark, filled)[0] == rows


def test_days_with_few_batches_wait(spark, filled):
    assert compaction.compact_days(spark, f"{filled}/events", store.EVENT_ROWS, 3, ["ts"], 5) == []
    assert compaction.manifest(spark, f"{filled}/events").version == {}
    assert compaction.compact_days(spark, f"{filled}/events", store.EVENT_ROWS, 4, ["ts"], 5) == [T0.date(), T0.date() + dt.timedelta(days=1)]
    assert compaction.compact_days(spark, f"{filled}/events", store.EVENT_ROWS, 4, ["ts"], 1) == []


def test_files_have_the_wanted_size_whatever_the_day_and_source(spark, make_events, tmp_path):
    root = str(tmp_path / "store")
    for number in range(3):
        store.write_batch(make_events(*[{"id": f"{number}-{i}", "at": i} for i in range(400)]), root, number, F.lit(T0))
    store.compact(spark, root, up_to=2, least_batches=3, rows_per_file=200)
    sizes = [spark.read.parquet(str(p)).count() for p in files(root, "events-compacted/version=1/event_date=*/*.parquet")]
    assert sum(sizes) == 1200 and 5 <= len(sizes) <= 7 and max(sizes) <= 320


def test_only_the_wanted_days_and_versions_are_opened(spark, filled):
    store.compact(spark, filled, up_to=3, least_batches=2)
    compaction.compact_days(spark, f"{filled}/events", store.EVENT_ROWS, 4, ["ts"], 1)
    day = store.read_events(spark, filled, F.lit(T0), F.lit(T0 + dt.timedelta(minutes=5)), every_copy=True)
    opened = day.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(opened) == 1 and "version=2/event_date=2024-01-01" in opened[0].f


def test_an_empty_store_has_no_rows(spark, tmp_path):
    root = str(tmp_path / "none")
    assert store.read_events(spark, root).count() == 0 == store.read_points(spark, root).count()
    store.compact(spark, root, up_to=3)


def test_the_stream_compacts_as_it_goes(spark, make_events, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    for number in range(5):
        batch_of(make_events, number).coalesce(1).write.mode("append").parquet(source)
    rows = spark.readStream.schema(TELEMETRY_EVENT).option("maxFilesPerTrigger", 1).parquet(source)
    streams.store_stream(rows, root, str(tmp_path / "check"), available_now=True, compact_every=2).awaitTermination()
    assert set(compaction.manifest(spark, f"{root}/events").up_to.values()) == {3}
    assert store.read_events(spark, root).count() == 20 and store.read_points(spark, root).count() == 20

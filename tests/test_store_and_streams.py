from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.operators.search import match_events
from tidewarden.operators.correlate import correlate
from tidewarden.operators.detect import detect_enriched, detect_raw
from tidewarden.operators.insights import annotate
from tidewarden.operators.rules import detect_rules
from tidewarden.schemas import INSIGHT, STATUS_UPDATE, TELEMETRY_EVENT
from tidewarden.sources import store, wire
from tidewarden.streaming import streams

FLUSH = {"id": "flush", "source": "flush", "at": 7200, "payload": '{"value": 0}', "correlation_id": "flush"}


def test_batch_write_and_rewrite(spark, make_events, tmp_path):
    root = str(tmp_path / "store")
    events = make_events(
        {"id": "l", "type": "log", "payload": "{}"},
        {"id": "m1", "payload": '{"metric": "cpu", "value": 1}'},
        {"id": "m2", "payload": '{"metric": "cpu", "value": 2}', "at": 86400},
        {"id": None, "payload": "{}"},
        {"id": "m3", "payload": "{}", "subtype": None},
    )
    for _ in range(2):  # the second write stands for a retried batch
        store.write_batch(events, root, 0)
    assert store.read_events(spark, root).count() == 4
    assert {p.id for p in store.read_points(spark, root).collect()} == {"m1-m", "m2-m"}
    rejected = spark.read.parquet(f"{root}/rejected").collect()
    assert {(r.id, tuple(r.reject_reasons)) for r in rejected} == {
        (None, ("id is blank",)), ("m3-m", ("metric name is missing",)),
    }
    first_day = store.read_events(spark, root, F.lit(T0), F.lit(T0 + dt.timedelta(minutes=5)))
    assert {e.id for e in first_day.collect()} == {"l", "m1", "m3"}
    assert "event_date" in first_day._jdf.queryExecution().executedPlan().toString()


def test_last_write_wins(spark, make_events, tmp_path):
    root = str(tmp_path / "store")
    store.write_batch(make_events({"id": "a", "subtype": "old"}), root, 0, F.lit(T0))
    store.write_batch(
        make_events({"id": "a", "subtype": "new"}, {"id": "b"}), root, 1,
        F.lit(T0 + dt.timedelta(seconds=1)),
    )
    current = store.current_events(store.read_events(spark, root)).collect()
    assert {(r.id, r.subtype) for r in current} == {("a", "new"), ("b", "rpm")}
    assert store.read_events(spark, root).count() == 2
    assert store.read_events(spark, root, every_copy=True).count() == 3
    assert store.read_points(spark, root, every_copy=True).count() == 3
    assert store.read_points(spark, root).count() == 2


def test_ranges_bound_the_days_read(spark, make_events, tmp_path):
    root = str(tmp_path / "store")
    store.write_batch(make_events({"id": "a"}, {"id": "b", "at": 86_400}), root, 0, F.lit(T0))
    stored = store.read_events(spark, root, every_copy=True)
    found = match_events(stored, start=F.lit(T0 + dt.timedelta(hours=20)))
    assert [r.id for r in found.collect()] == ["b"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_a_batch_reads_only_its_alert_buckets(spark, tmp_path):
    root = str(tmp_path / "alerts")
    made = spark.range(200).select(
        F.concat(F.lit("a"), F.col("id")).alias("anomaly_id"), F.lit("x").alias("id"), F.lit("WARNING").alias("severity"),
        F.lit("t").alias("incident_classification"), F.lit("i").alias("interpretation"),
        F.array(F.lit("r")).alias("recommendations"), F.lit(T0).alias("analyzed_at"),
        F.create_map(F.lit("service"), F.lit("s")).alias("metadata"),
    )
    streams.write_alert_batch(made, 0, root)
    assert streams.stored_alerts(spark, root).count() == 200
    part = streams.stored_alerts(spark, root, 1, [3])
    assert 0 < part.count() < 20
    assert "PartitionFilters: [isnotnull(bucket" in part._jdf.queryExecution().executedPlan().toString()
    streams.write_alert_batch(made.where("anomaly_id < 'a2'"), 1, root)
    assert streams.stored_alerts(spark, root).count() == 200


def test_a_retried_batch_gives_alerts_without_an_anomaly_the_same_ids(spark, tmp_path):
    """Also when the retry is partitioned otherwise: nothing is stored twice."""
    made = spark.range(40).select(
        F.lit(" ").alias("anomaly_id"), F.concat(F.lit("i"), F.col("id") % 8).alias("id"), F.lit("WARNING").alias("severity"),
        F.lit("t").alias("incident_classification"), F.lit("i").alias("interpretation"),
        F.array(F.lit("r")).alias("recommendations"), F.lit(T0).alias("analyzed_at"),
        F.create_map(F.lit("service"), F.lit("s")).alias("metadata"),
    )
    root, found = str(tmp_path / "alerts"), []
    for parts in (1, 7, 3):
        streams.write_alert_batch(made.repartition(parts), 4, root)
        found.append({r.id for r in streams.stored_alerts(spark, root).collect()})
    assert len(found[0]) == 40 and found[0] == found[1] == found[2]
    assert streams.stored_alerts(spark, root).count() == 40


def _feed(spark, frame, folder):
    """Write a frame as one new input file of a stream folder."""
    frame.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(TELEMETRY_EVENT).parquet(str(folder))


@pytest.fixture
def spiky(make_events):
    rows = [
        {"id": f"v{i}", "payload": f'{{"metric": "m", "value": {v}}}', "correlation_id": f"c{i % 2}",
         "source": "web"}
        for i, v in enumerate([1] * 30 + [99])
    ]
    return make_events(*rows), make_events(*rows, FLUSH)


def test_streamed_detectors_equal_batch(spark, spiky, tmp_path):
    plain, flushed = spiky
    stream = _feed(spark, flushed, tmp_path / "in")
    raw = streams.run_to_table(streams.raw_zscore_stream(stream), "raw")
    batch = detect_raw(plain)
    assert raw.count() == 1
    assert raw.exceptAll(batch).count() == 0 and batch.exceptAll(raw).count() == 0
    enriched = streams.run_to_table(streams.enriched_zscore_stream(stream), "enriched")
    assert {r.id for r in enriched.collect()} == {
        r.id for r in detect_enriched(plain, context=False).collect()
    }


def test_streamed_correlation_equals_batch(spark, spiky, tmp_path):
    plain, flushed = spiky
    stream = _feed(spark, flushed, tmp_path / "in")
    rows = streams.run_to_table(streams.correlate_stream(stream), "corr")
    batch = {r.id: r for r in correlate(plain).collect()}
    made = {r.id: r for r in rows.collect()}
    assert set(made) == set(batch)
    for name, row in made.items():
        assert row.correlated_count == batch[name].correlated_count
        assert row.unique_services == batch[name].unique_services


def test_rows_behind_the_watermark_are_dropped(spark, make_events, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    first = make_events({"id": "a", "correlation_id": "c", "at": 0}, FLUSH)
    late = make_events({"id": "late", "correlation_id": "c", "at": 1})
    for frame in (first, late):
        stream = streams.correlate_stream(_feed(spark, frame, folder))
        streams.append_writer(stream, out, checkpoint, available_now=True).start().awaitTermination()
    assert [r.id for r in spark.read.parquet(out).collect()] == ["a"]


def test_restart_neither_loses_nor_repeats(spark, make_events, tmp_path):
    """Events of one window arrive in two runs; the window closes in the third."""
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    values = [1] * 30 + [99]
    rows = [{"id": f"v{i}", "payload": f'{{"metric": "m", "value": {v}}}', "at": 30} for i, v in enumerate(values)]
    for part in (make_events(*rows[:15]), make_events(*rows[15:]), make_events(FLUSH), make_events(FLUSH)):
        stream = streams.raw_zscore_stream(_feed(spark, part, folder))
        streams.append_writer(stream, out, checkpoint, available_now=True).start().awaitTermination()
    found = spark.read.parquet(out).collect()
    assert [r.event_id for r in found] == ["v30"]


def test_alerts_once_across_batches_and_retries(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "alerts")

    def deliver(*names):
        rows = [
            (f"i{n}", n, "WARNING", 1.0, "x", "y", [], [], "", T0, {"service": "s"}) for n in names
        ]
        spark.createDataFrame(rows, INSIGHT).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(INSIGHT).parquet(folder)
        streams.alert_stream(source, root, str(tmp_path / "cp"), available_now=True).awaitTermination()

    deliver("a", "b", "a")
    deliver("b", "c")
    assert sorted(r.anomaly_id for r in streams.stored_alerts(spark, root).collect()) == ["a", "b", "c"]
    # A retry of the last batch, as after a crash between write and commit.
    deliver_again = spark.read.schema(INSIGHT).parquet(folder).where(F.col("anomaly_id").isin("b", "c"))
    streams.write_alert_batch(deliver_again, 1, root)
    assert sorted(r.anomaly_id for r in streams.stored_alerts(spark, root).collect()) == ["a", "b", "c"]


def test_status_requests_change_stored_alerts(spark, tmp_path):
    root, changes, inbox = (str(tmp_path / n) for n in ("alerts", "changes", "in"))
    rows = [(f"i{n}", n, "WARNING", 1.0, "x", "y", [], [], "", T0, {}) for n in "abc"]
    streams.write_alert_batch(spark.createDataFrame(rows, INSIGHT), 0, root)
    ids = {r.anomaly_id: r.id for r in streams.stored_alerts(spark, root).collect()}

    def ask(name, status, at):
        asked = [(ids[name], status, T0 + dt.timedelta(hours=at))]
        spark.createDataFrame(asked, STATUS_UPDATE).coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(STATUS_UPDATE).parquet(inbox)
        query = streams.status_stream(source, root, changes, str(tmp_path / "cp"), available_now=True)
        query.awaitTermination()
        found = streams.current_alerts(spark, root, changes).collect()
        return {r.anomaly_id: (r.status, r.resolved_at) for r in found}

    opened = ("OPEN", None)
    assert ask("a", "ACK", 1) == {"a": ("ACK", None), "b": opened, "c": opened}
    done = ("RESOLVED", T0 + dt.timedelta(hours=2))
    assert ask("a", "RESOLVED", 2) == {"a": done, "b": opened, "c": opened}
    assert ask("a", "OPEN", 3)["a"] == done
    again = spark.createDataFrame([(ids["a"], "RESOLVED", T0 + dt.timedelta(hours=2))], STATUS_UPDATE)
    streams.write_status_batch(again, 1, root, changes)  # a retry of the second batch
    assert {r.anomaly_id: r.status for r in streams.current_alerts(spark, root, changes).collect()} == {
        "a": "RESOLVED", "b": "OPEN", "c": "OPEN",
    }


def test_store_stream_and_stateless_rules(spark, make_events, tmp_path):
    events = make_events(
        {"id": "l", "type": "log", "payload": '{"level": "ERROR", "message": "m"}'},
        {"id": "m", "payload": '{"metric": "cpu", "value": 1}'},
    )
    wire.encode_events(events).select("value").coalesce(1).write.text(str(tmp_path / "raw"))
    messages = wire.json_stream(spark, str(tmp_path / "raw"))
    decoded = wire.decode_events(messages).valid
    root = str(tmp_path / "store")
    streams.store_stream(decoded, root, str(tmp_path / "cp1"), available_now=True).awaitTermination()
    assert store.read_events(spark, root).count() == 2 and store.read_points(spark, root).count() == 1
    found = streams.run_to_table(annotate(detect_rules(decoded)), "rules")
    assert [r.incident_classification for r in found.collect()] == ["ErrorSpike"]

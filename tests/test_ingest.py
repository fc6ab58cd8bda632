from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden import schemas
from tidewarden.operators import normalize
from tidewarden.operators.correlate import correlate, enriched_record
from tidewarden.operators.detect import detect_raw
from tidewarden.operators.insights import annotate
from tidewarden.operators.rollup import metric_points
from tidewarden.operators.alerts import broadcast_notices, create_alerts
from tidewarden.sources import requests, sensors, wire

def as_of():
    return F.lit(dt.datetime(2024, 2, 1))


def test_event_request(spark):
    frame = spark.createDataFrame(
        [("s", "custom", None, None, "c1", {"a": "b"}, None), (None, "t", None, "{}", None, None, T0),
         ("s", "  ", None, "{}", None, None, T0), ("s", " ", None, "{}", None, None, T0)],
        schemas.EVENT_REQUEST,
    )
    made = normalize.ingest(frame, "event", as_of())
    row = made.valid.collect()[0]
    assert (row.type, row.payload, row.ts, row.correlation_id) == (
        "custom", "{}", dt.datetime(2024, 2, 1), "c1",
    )
    assert len(row.id) == 32 and row.tags == {"a": "b"}
    reasons = [r.reject_reasons for r in made.rejected.collect()]
    assert reasons == [["source is blank"], ["type is blank"]]
    # The em space passes the request rule and is stopped by the event rule.
    assert made.valid.count() == 1


def test_log_metric_and_trace_requests(spark):
    log = spark.createDataFrame(
        [("s", "ERROR", "boom", "other", "c", None, T0), ("s", "INFO", " ", None, None, None, T0)],
        schemas.LOG_REQUEST,
    )
    made = normalize.ingest(log, "log", as_of())
    row = made.valid.collect()[0]
    assert (row.type, row.subtype, row.source) == ("log", "error", "s")
    assert json.loads(row.payload) == {"level": "ERROR", "message": "boom"}
    assert made.rejected.collect()[0].reject_reasons == ["message is blank"]

    metric = spark.createDataFrame(
        [("s", "queue.depth", 12.25, None, T0), ("s", "cpu", None, None, T0)], schemas.METRIC_REQUEST
    )
    made = normalize.ingest(metric, "metric", as_of())
    row = made.valid.collect()[0]
    assert row.correlation_id is None and row.subtype == "queue.depth"
    assert json.loads(row.payload) == {"metric": "queue.depth", "value": 12.25}
    assert made.rejected.collect()[0].reject_reasons == ["value is missing"]

    trace = spark.createDataFrame(
        [("t1", "s1", None, "web", "get", 12, T0, None), ("t1", "s1", "p", "web", "get", 12, None, T0)],
        schemas.TRACE_REQUEST,
    )
    first, second = normalize.ingest(trace, "trace", as_of()).valid.orderBy(F.desc("ts")).collect()
    assert (first.source, first.correlation_id, first.tags) == ("web", "t1", {"service": "web"})
    assert json.loads(first.payload) == {
        "traceId": "t1", "spanId": "s1", "parentSpanId": "", "operation": "get",
        "durationMs": 12, "startTime": "2024-01-01T10:00:00Z",
    }
    assert json.loads(second.payload)["startTime"] == ""


def test_defaults(spark):
    frame = spark.createDataFrame(
        [(None, None, None)], "severity string, status string, detected_at timestamp"
    )
    row = normalize.with_alert_defaults(frame, as_of()).collect()[0]
    assert tuple(row) == ("WARNING", "OPEN", dt.datetime(2024, 2, 1))


def test_wire_roundtrip_keeps_open_payload_and_micros(make_events):
    frame = make_events(
        {"id": "a", "payload": '{"x": {"y": [1, 2.5, "z"]}, "n": null}', "tags": {"k": "v"},
         "correlation_id": "c", "at": 0.123456},
        {"id": "b", "payload": None, "subtype": None},
    )
    messages = wire.encode_events(frame)
    first = json.loads(messages.orderBy("value").collect()[0].value)
    assert first["payload"]["x"] == {"y": [1, 2.5, "z"]} and first["timestamp"].endswith(".123456Z")
    assert {m.key for m in messages.collect()} == {"engine-1:metric"}
    back = {r.id: r for r in wire.decode_events(messages).valid.collect()}
    assert back["a"].ts == T0 + dt.timedelta(microseconds=123456)
    assert json.loads(back["a"].payload)["n"] is None and back["a"].tags == {"k": "v"}
    assert back["b"].payload is None and back["b"].correlation_id is None


def test_bad_messages_go_to_rejects(spark):
    good = '{"id": "a", "source": "s", "type": "t", "timestamp": "2024-01-01T00:00:00Z"}'
    rows = [
        (good,), (None,), ("",), ("{broken",), ("[1]",),
        ('{"source": " ", "type": "t"}',), ('{"source": "s", "type": "t"}',),
    ]
    made = wire.decode_events(spark.createDataFrame(rows, "value string"), as_of())
    assert {(r.id, r.ts) for r in made.valid.collect()} == {
        ("a", dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 2, 1)),
    }
    reasons = {r.value: r.reject_reasons for r in made.rejected.collect()}
    assert reasons["{broken"] == ["malformed JSON"]
    assert reasons['{"source": " ", "type": "t"}'] == ["source is blank"]
    assert "[1]" in reasons and len(reasons) == 3


def test_other_records_roundtrip(metric_events):
    events = metric_events([100] * 19 + [3000], correlation_id="c")
    enriched = enriched_record(correlate(events))
    back = wire.decode_enriched(wire.encode_enriched(enriched)).valid
    assert back.select("original.id").exceptAll(events.select("id")).count() == 0
    row = back.collect()[0]
    assert row.enrichment_metadata.correlatedCount == 20

    anomalies = detect_raw(events)
    messages = wire.encode_anomalies(anomalies)
    assert messages.collect()[0].key == "engine-1:rpm"
    again = wire.decode_anomalies(messages).valid.collect()[0]
    assert json.loads(again.details)["windowSize"] == 20

    found = annotate(anomalies)
    sent = wire.encode_insights(found)
    assert sent.collect()[0].key == anomalies.collect()[0].id
    assert wire.decode_insights(sent).valid.collect()[0].metadata == {
        "service": "engine-1", "metric": "rpm",
    }
    notice = json.loads(wire.encode_notices(broadcast_notices(create_alerts(found))).collect()[0].value)
    assert set(notice) == {"id", "severity", "source", "detectedAt"}


def test_request_arrays_and_receipts(spark, tmp_path):
    body = '[{"source": "s", "type": "t"}, {"source": "u", "type": "t", "payload": {"a": 1}}]'
    (tmp_path / "batch.json").write_text(body)
    read = requests.read_request_arrays(spark, str(tmp_path))
    assert {r.source for r in read.collect()} == {"s", "u"}
    bodies = spark.createDataFrame([(1, body)], "batch_id int, body string")
    exploded = requests.explode_requests(bodies)
    assert [json.loads(r.payload) for r in exploded.where("payload is not null").collect()] == [{"a": 1}]
    events = normalize.normalize_event(exploded.drop("batch_id"), as_of()).withColumn("batch_id", F.lit(1))
    receipt = requests.batch_receipts(events).collect()[0]
    assert receipt["count"] == 2
    assert len({r.id for r in requests.receipt_ids(events).collect()}) == 2


def test_sensor_files(spark, tmp_path):
    (tmp_path / "termo.csv").write_text(
        "packet_id,event_time,tr_id,unit_id,sensor_id,val,status\n"
        "123,2024-03-02T07:08:09Z,7001,7002,7003,5.0,1\n"
    )
    (tmp_path / "fuel.csv").write_text(
        "packet_id,event_time,sensor_id,tr_id,level_mm,level_l,temperature,switched_on\n"
        "7,2024-03-02T07:08:10Z,9,8,100.5,50.25,20.0,true\n"
    )
    events = sensors.sensor_events(
        sensors.read_sensor_csv(spark, str(tmp_path / "termo.csv"), "termo"),
        sensors.read_sensor_csv(spark, str(tmp_path / "fuel.csv"), "fuel"),
    )
    rows = {r.source: r for r in events.collect()}
    assert json.loads(rows["termo-sensor"].payload) == {"packet_id": 123, "val": 5.0, "status": 1}
    assert rows["termo-sensor"].tags == {
        "tr_id": "7001", "unit_id": "7002", "sensor_id": "7003",
    }
    assert rows["fuel-sensor"].subtype == "fuel-level"
    assert json.loads(rows["fuel-sensor"].payload)["switched_on"] is True
    assert {p.value for p in metric_points(events).points.collect()} == {0.0}


def test_instants_print_in_utc_in_any_session_zone(spark):
    from tidewarden.functions.text import iso_instant

    frame = spark.sql("SELECT timestamp_micros(1704067200123000) AS t, timestamp_ntz'2024-01-01 00:00:00' AS n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            row = frame.select(iso_instant(F.col("t")).alias("t"), iso_instant(F.col("n")).alias("n")).first()
            assert tuple(row) == ("2024-01-01T00:00:00.123Z", "2024-01-01T00:00:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ids_do_not_merge_parts(spark):
    from tidewarden.functions.text import stable_id

    frame = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None)], "x string, y string")
    assert frame.select(stable_id(F.col("x"), F.col("y"))).distinct().count() == 4

from __future__ import annotations

import json

import pytest

from tidewarden.operators.detect import detect_enriched, detect_raw, union_anomalies
from tidewarden.operators.rules import apply_rule, detect_rules, error_rule, latency_rule


@pytest.mark.parametrize("strategy", ["salted", "adaptive"])
@pytest.mark.parametrize(
    ("values", "severity", "score"),
    [
        ([100] * 19 + [3000], "WARNING", 4.358898943540673),
        ([100] * 50 + [50000], "CRITICAL", 7.0710678118654755),
        ([100] * 10 + [3000], "WARNING", 3.1622776601683795),
        ([100] * 25 + [3000], "WARNING", 5.0),
        ([100] * 26 + [3000], "CRITICAL", 5.0990195135927845),
    ],
)
def test_one_outlier_fires(metric_events, strategy, values, severity, score):
    hits = detect_raw(metric_events(values), strategy=strategy).collect()
    assert [(h.severity, h.service, h.metric) for h in hits] == [(severity, "engine-1", "rpm")]
    assert hits[0].score == pytest.approx(score, abs=1e-9)


@pytest.mark.parametrize(
    "values",
    [
        [100, 100, 9000],
        [100 + 0.5 * i for i in range(10)],
        [100] * 9 + [3000],
        [100] * 20,
        [1, 2, 3, 4, '{"metric": "rpm", "value": "5"}'],
    ],
)
def test_silent_groups(metric_events, values):
    assert detect_raw(metric_events(values)).count() == 0


def test_non_numbers_count_in_the_window_but_not_in_the_mean(metric_events):
    odd = [f'{{"metric": "rpm", "value": {v}}}' for v in ('"9999"', "null", "true")]
    hit = detect_raw(metric_events([100] * 19 + [3000] + odd)).collect()[0]
    details = json.loads(hit.details)
    assert details["mean"] == 245 and details["windowSize"] == 23
    assert hit.description == "Z-score 4.36 for rpm (value=3000.0, mean=245.0, stddev=632.0)"


def test_missing_payload_name_and_colon_in_source(metric_events, make_events):
    rows = [{"payload": '{"value": 1}', "subtype": None} for _ in range(19)]
    hit = detect_raw(make_events(*rows, {"payload": '{"value": 99}', "subtype": None})).collect()[0]
    assert hit.metric == "unknown"
    spiky = metric_events([1] * 19 + [99], source="host:80", metric="cpu")
    assert [(h.service, h.metric) for h in detect_raw(spiky).collect()] == [("host:80", "cpu")]


def test_ids_do_not_change_on_replay(metric_events):
    frame = metric_events([100] * 19 + [3000])
    assert detect_raw(frame).collect()[0].id == detect_raw(frame).collect()[0].id


def test_enriched_needs_a_correlation_id_and_carries_context(metric_events):
    plain = metric_events([100] * 19 + [3000])
    assert detect_enriched(plain).count() == 0
    hit = detect_enriched(metric_events([100] * 19 + [3000], correlation_id="c")).collect()[0]
    details = json.loads(hit.details)
    assert details["correlatedCount"] == 20 and details["uniqueServices"] == 1


def test_context_spans_other_services_of_the_group(make_events):
    rows = [
        {"payload": f'{{"metric": "m", "value": {v}}}', "correlation_id": "c"}
        for v in [1] * 19 + [99]
    ]
    rows.append({"id": "log", "type": "log", "source": "web", "correlation_id": "c", "payload": "{}"})
    rows.append({"id": "far", "source": "far", "correlation_id": "other", "payload": "{}"})
    details = json.loads(detect_enriched(make_events(*rows)).collect()[0].details)
    assert details["uniqueServices"] == 2 and details["correlatedCount"] == 21


def test_ids_shared_between_correlation_groups_count_once(make_events):
    """Copies of an id under several correlation ids, against a plain set union."""
    rows = [
        {"id": f"i{i % 25}", "payload": f'{{"metric": "m", "value": {v}}}', "correlation_id": f"c{i % 4}"}
        for i, v in enumerate([1] * 39 + [99])
    ]
    rows.append({"id": "i3", "type": "log", "payload": "{}", "correlation_id": "elsewhere"})
    rows.append({"id": None, "type": "log", "payload": "{}", "source": "nameless", "correlation_id": "c1"})
    frame = make_events(*rows)
    details = json.loads(detect_enriched(frame).collect()[0].details)
    assert details["correlatedCount"] == 25 and details["uniqueServices"] == 2


@pytest.mark.parametrize("values", [["1e999"], ["-1e999", "1e999"], ["1e308", "-1e308"] * 5])
def test_values_beyond_any_statistic_fire_nothing(metric_events, values):
    odd = [f'{{"metric": "rpm", "value": {v}}}' for v in values]
    frame = metric_events([100] * 19 + odd, correlation_id="c")
    assert detect_raw(frame).count() == 0
    assert detect_raw(frame, strategy="adaptive").count() == 0
    assert detect_enriched(frame).count() == 0


def test_hits_without_an_event_id_keep_ids_of_their_own(make_events):
    rows = [{"payload": f'{{"metric": "m", "value": {v}}}'} for v in [1] * 40]
    rows += [{"id": None, "payload": f'{{"metric": "m", "value": {v}}}'} for v in (990, 999)]
    found = detect_raw(make_events(*rows)).collect()
    assert len(found) == 2 and len({f.id for f in found}) == 2


def test_a_correlated_spike_appears_once_per_detector(metric_events):
    frame = metric_events([100] * 19 + [3000], correlation_id="c")
    both = union_anomalies(detect_raw(frame), detect_enriched(frame), detect_rules(frame))
    assert sorted(r.detector for r in both.collect()) == ["enriched-zscore", "raw-zscore"]


def test_error_rule(make_events):
    rows = [
        {"type": "log", "payload": f'{{"level": "{level}", "message": "boom"}}'}
        for level in ("ERROR", "FATAL", "WARN", "error")
    ]
    rows += [
        {"type": "log", "payload": '{"level": "ERROR"}'},
        {"type": "metric", "payload": '{"level": "ERROR", "message": "not a log"}'},
        {"type": "log", "payload": None},
    ]
    found = apply_rule(make_events(*rows), error_rule()).orderBy("event_id").collect()
    assert [(f.event_id, f.description) for f in found] == [
        ("e0", "Error detected: boom"),
        ("e1", "Error detected: boom"),
        ("e4", "Error detected: null"),
    ]
    assert json.loads(found[2].details) == {"level": "ERROR", "message": None}
    assert {(f.metric, f.score, f.severity) for f in found} == {("error-rate", 1.0, "WARNING")}


def test_huge_durations_saturate(make_events):
    rows = [
        {"type": "trace", "payload": f'{{"durationMs": {v}, "operation": "get"}}'}
        for v in ("1e30", "1e999", "-1e30")
    ]
    found = apply_rule(make_events(*rows), latency_rule()).collect()
    assert [json.loads(f.details)["durationMs"] for f in found] == [2**63 - 1] * 2


def test_latency_rule(make_events):
    values = ["999", "999.9", "1000", "5000", "5001", '"2000"']
    rows = [
        {"type": "trace", "payload": f'{{"durationMs": {v}, "operation": "get"}}'} for v in values
    ]
    found = apply_rule(make_events(*rows), latency_rule()).orderBy("event_id").collect()
    assert [(f.event_id, f.score, f.severity) for f in found] == [
        ("e2", 1.0, "WARNING"),
        ("e3", 5.0, "WARNING"),
        ("e4", 5.001, "CRITICAL"),
    ]
    assert found[0].description == "High latency: 1000ms for get"
    assert json.loads(found[0].details) == {"durationMs": 1000, "operation": "get"}

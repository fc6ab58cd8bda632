from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.operators import alert_stats, alerts
from tidewarden.schemas import ALERT, INSIGHT, STATUS_UPDATE

def now():
    return F.lit(T0)


def hours(n: float) -> dt.datetime:
    return T0 + dt.timedelta(hours=n)


@pytest.fixture
def insight(spark):
    def make(*rows):
        full = [
            (
                r.get("id", f"i{n}"), r.get("anomaly_id", f"a{n}"), r.get("severity"), 1.0,
                r.get("interpretation"), "LatencyIssue", None, r.get("recommendations"), "",
                r.get("at", T0), r.get("metadata"),
            )
            for n, r in enumerate(rows)
        ]
        return spark.createDataFrame(full, INSIGHT)

    return make


@pytest.fixture
def table(spark):
    def make(*rows):
        full = [
            (
                r.get("id", f"x{n:02}"), "t", r.get("severity", "WARNING"), r.get("status", "OPEN"),
                r.get("source", "svc"), "", "", f"a{n}", r.get("at", T0), None,
            )
            for n, r in enumerate(rows)
        ]
        return spark.createDataFrame(full, ALERT)

    return make


def test_alert_from_insight(insight):
    full = {
        "interpretation": "slow", "recommendations": ["look", "restart"], "severity": "CRITICAL",
        "metadata": {"service": "web", "metric": "latency"},
    }
    rows = {a.anomaly_id: a for a in alerts.create_alerts(insight(full, {"metadata": {}})).collect()}
    a = rows["a0"]
    assert (a.title, a.description, a.recommendation) == (
        "Anomaly a0: LatencyIssue", "slow", "look; restart",
    )
    assert (a.source, a.status, a.severity, a.resolved_at) == ("web", "OPEN", "CRITICAL", None)
    b = rows["a1"]
    assert (b.description, b.recommendation, b.source, b.severity) == (
        "No interpretation", "", "unknown", "WARNING",
    )


def test_first_alert_per_anomaly_wins_and_blank_ids_stay_apart(insight):
    frame = insight(
        {"anomaly_id": "same", "at": hours(2), "interpretation": "late"},
        {"anomaly_id": "same", "at": hours(1), "interpretation": "early"},
        {"id": "twin", "anomaly_id": None},
        {"id": "twin", "anomaly_id": None},
        {"anomaly_id": "  "},
    )
    rows = alerts.create_alerts(frame).collect()
    assert [r.description for r in rows if r.anomaly_id == "same"] == ["early"]
    assert len(rows) == 4 and len({r.id for r in rows}) == 4
    assert alerts.create_alerts(frame, alerts.create_alerts(frame)).count() == 3


def _apply(spark, table, rows, requests):
    frame = table(*rows)
    asked = spark.createDataFrame(requests, STATUS_UPDATE)
    result = alerts.apply_status_updates(frame, asked)
    state = {r.id: (r.status, r.resolved_at) for r in result.alerts.collect()}
    return state, result


def test_allowed_steps(spark, table):
    state, result = _apply(
        spark, table,
        [{"id": "p"}, {"id": "q"}, {"id": "r", "status": "ACK"}, {"id": "s"}],
        [("p", "ACK", T0), ("q", "RESOLVED", T0), ("r", "RESOLVED", hours(1))],
    )
    assert state == {
        "p": ("ACK", None), "q": ("RESOLVED", T0), "r": ("RESOLVED", hours(1)), "s": ("OPEN", None),
    }
    assert result.accepted.count() == 3 and result.rejected.count() == 0


def test_refused_steps_and_unknown_alerts(spark, table):
    state, result = _apply(
        spark, table,
        [{"id": "p", "status": "RESOLVED"}, {"id": "q"}, {"id": "r", "status": "ACK"},
         {"id": "s", "status": "PARKED"}],
        [("p", "OPEN", T0), ("q", "OPEN", T0), ("r", "OPEN", T0), ("r", "ACK", T0),
         ("s", "ACK", T0), ("nobody", "ACK", T0)],
    )
    assert {k: v[0] for k, v in state.items()} == {
        "p": "RESOLVED", "q": "OPEN", "r": "ACK", "s": "PARKED",
    }
    assert {(r.alert_id, r.new_status, r.old_status) for r in result.rejected.collect()} == {
        ("p", "OPEN", "RESOLVED"), ("q", "OPEN", "OPEN"), ("r", "OPEN", "ACK"), ("r", "ACK", "ACK"),
        ("s", "ACK", "PARKED"),
    }
    assert [r.alert_id for r in result.not_found.collect()] == ["nobody"]


def test_request_sequences_match_a_replay(spark, table):
    """Every sequence of up to three requests against a step-by-step replay."""
    import itertools

    allowed = {("OPEN", "ACK"), ("ACK", "RESOLVED"), ("OPEN", "RESOLVED")}
    words = ["OPEN", "ACK", "RESOLVED"]
    rows, requests, expected, refused = [], [], {}, set()
    cases = itertools.product(words, itertools.product(words, repeat=3))
    for n, (initial, asked) in enumerate(cases):
        name, state, resolved = f"c{n}", initial, None
        rows.append({"id": name, "status": initial})
        for step, word in enumerate(asked):
            at = hours(step)
            requests.append((name, word, at))
            if (state, word) in allowed:
                state = word
                resolved = at if word == "RESOLVED" else resolved
            else:
                refused.add((name, word, at, state))
        expected[name] = (state, resolved)
    state, result = _apply(spark, table, rows, requests)
    assert state == expected
    assert {tuple(r)[:3] + (r.old_status,) for r in result.rejected.collect()} == refused


def test_equal_requests_are_counted(spark, table):
    _, result = _apply(spark, table, [{"id": "p"}], [("p", "ACK", T0)] * 3)
    assert result.accepted.count() == 1
    left = result.rejected.collect()[0]
    assert (left.copies, left.old_status) == (2, "ACK")


def test_list_precedence(table):
    frame = table(
        {"status": "OPEN", "severity": "CRITICAL", "at": hours(-1)},
        {"status": "ACK", "severity": "CRITICAL", "at": hours(-2)},
        {"status": "OPEN", "severity": "WARNING", "at": hours(-3)},
        {"status": "OPEN", "severity": "WARNING", "at": hours(-4)},
    )

    def ids(**criteria):
        return [r.id for r in alerts.list_alerts(frame, **criteria).collect()]

    assert ids(status="OPEN", severity="CRITICAL", limit=1) == ["x00", "x02", "x03"]
    assert ids(status=" ", severity="CRITICAL", limit=1) == ["x00", "x01"]
    assert ids(since="2024-01-01T07:00:00Z", until="2024-01-01T09:00:00Z") == ["x01", "x02"]
    assert ids(since="2024-01-01T07:00:00Z") == ["x00", "x01", "x02"]
    assert ids(until="2024-01-01T07:00:00Z", limit=-1) == ["x00", "x01", "x02", "x03"]
    assert ids(limit=2) == ["x00", "x01"]
    assert [r.id for r in alerts.alerts_of_hour(frame, "2024-01-01T08:00:00").collect()] == ["x01"]


def test_notifications(table):
    frame = table({})
    assert alerts.notifications(frame).columns == [
        "type", "id", "title", "severity", "status", "source", "detectedAt",
    ]
    assert alerts.broadcast_notices(frame).columns == ["id", "severity", "source", "detectedAt"]


def test_statistics(table):
    rows = [{"source": f"s{n:02}", "at": hours(-2)} for n in range(12)]
    rows += [{"source": "s11", "status": "ACK", "severity": "CRITICAL", "at": hours(-1)}]
    rows += [{"source": "s11", "status": "RESOLVED", "at": hours(-0.5)}]
    rows += [{"source": "s11", "at": hours(-30)}]
    frame = table(*rows)
    top = alert_stats.top_sources(frame).collect()
    assert [r.source for r in top] == ["s11"] + [f"s{n:02}" for n in range(9)]
    assert tuple(alert_stats.totals(frame, now()).collect()[0]) == (15, 1, 14, 1, 14)
    assert [(r.hour, r["count"]) for r in alert_stats.hourly(frame, now()).collect()] == [
        (hours(-2), 12), (hours(-1), 2),
    ]
    summary = alert_stats.alert_summary(frame).collect()[0]
    assert (summary.open_count, summary.acknowledged_count, summary.resolved_count) == (13, 1, 1)
    assert [tuple(s) for s in summary.open_by_severity] == [("WARNING", 13)]
    whole = alert_stats.alert_statistics_row(frame, now()).collect()[0]
    assert [s.source for s in whole.by_source][:2] == ["s11", "s00"] and len(whole.hourly) == 2
    assert {(r.status, r["count"]) for r in alert_stats.by_status(frame).collect()} == {
        ("OPEN", 13), ("ACK", 1), ("RESOLVED", 1),
    }


def test_empty_hours_are_absent_and_shares_round(table):
    frame = table({"at": hours(-3)}, {"at": hours(-1)}, {"at": hours(-1)}, {"at": hours(-1)})
    bars = alert_stats.hourly_bars(frame, now()).collect()
    assert [(b["count"], b.share) for b in bars] == [(1, 24), (3, 72)]
    nothing = frame.limit(0)
    assert alert_stats.shares(alert_stats.by_severity(nothing)).count() == 0
    row = alert_stats.alert_statistics_row(nothing, now()).collect()[0]
    assert (row.total, row.last_day, row.by_source, row.hourly) == (0, 0, [], [])
    assert tuple(alert_stats.alert_summary(nothing).collect()[0]) == (0, 0, 0, [])

"""The status machine as keyed state of a stream."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest

from tests.conftest import T0
from tidewarden.operators.alerts import apply_status_updates
from tidewarden.schemas import ALERT, STATUS_UPDATE
from tidewarden.streaming import status


def alert(name, state="OPEN"):
    return (name, "t", "WARNING", state, "s", "d", "r", f"an-{name}", T0, None)


def ask(name, wanted, minutes):
    return (name, wanted, None if minutes is None else T0 + dt.timedelta(minutes=minutes))


@pytest.fixture
def desk(spark, tmp_path):
    """Bring alerts and requests in as one more micro-batch, with a fresh query each time."""
    home = str(tmp_path)
    spark.createDataFrame([], ALERT).write.parquet(f"{home}/alerts")
    spark.createDataFrame([], STATUS_UPDATE).write.parquet(f"{home}/requests")

    def run(alerts=(), requests=()):
        for rows, schema, name in ((alerts, ALERT, "alerts"), (requests, STATUS_UPDATE, "requests")):
            if rows:
                spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{home}/{name}")
        streams = [spark.readStream.schema(s).parquet(f"{home}/{n}") for s, n in ((ALERT, "alerts"), (STATUS_UPDATE, "requests"))]
        status.status_state_stream(*streams, f"{home}/judged", f"{home}/checkpoint", available_now=True).awaitTermination()
        return spark.read.parquet(f"{home}/judged")

    return run


def outcomes(frame):
    return sorted(
        (r.alert_id, r.new_status or "", str(r.at), r.old_status or "", r.outcome, r.copies) for r in frame.select("alert_id", "new_status", "at", "old_status", "outcome", "copies").collect()
    )


ALERTS = [alert("a"), alert("b"), alert("c", "ACK"), alert("d", "RESOLVED"), alert("e")]
FIRST = [
    ask("a", "ACK", 1), ask("a", "ACK", 1), ask("a", "OPEN", 2), ask("b", "RESOLVED", 3), ask("b", "ACK", 2),
    ask("c", "ACK", 1), ask("c", "RESOLVED", 4), ask("c", "RESOLVED", 4), ask("d", "RESOLVED", 1), ask("x", "ACK", 1),
    ask("e", None, 1), ask("e", "BOGUS", 2), ask(None, "ACK", 1), ask("e", "ACK", None),
]
SECOND = [ask("a", "RESOLVED", 5), ask("a", "ACK", 6), ask("b", "RESOLVED", 7), ask("e", "RESOLVED", 8), ask("x", "ACK", 9)]


def test_one_batch_equals_the_batch_form(spark, desk):
    made = desk(ALERTS, FIRST)
    wanted = apply_status_updates(spark.createDataFrame(ALERTS, ALERT), spark.createDataFrame(FIRST, STATUS_UPDATE))
    assert outcomes(made) == outcomes(wanted.outcomes)


def test_state_outlives_a_restart(spark, desk):
    desk(ALERTS, FIRST[:6])
    desk([], FIRST[6:])
    made = desk([], SECOND)
    both = apply_status_updates(spark.createDataFrame(ALERTS, ALERT), spark.createDataFrame(FIRST + SECOND, STATUS_UPDATE))
    assert outcomes(made) == outcomes(both.outcomes)
    now = status.with_status(spark.createDataFrame(ALERTS, ALERT), made)
    key = lambda r: r.id
    assert sorted(now.collect(), key=key) == sorted(both.alerts.collect(), key=key)


def test_requests_before_their_alert_are_not_found(desk):
    desk([], [ask("late", "ACK", 1)])
    made = desk([alert("late")], [ask("late", "RESOLVED", 2)])
    assert [(r.new_status, r.outcome, r.old_status, r.status) for r in made.orderBy("at").collect()] == [
        ("ACK", "not found", None, None), ("RESOLVED", "accepted", "OPEN", "RESOLVED"),
    ]


def test_an_alert_that_comes_again_changes_nothing(desk):
    desk([alert("a")], [ask("a", "ACK", 1)])
    made = desk([alert("a")], [ask("a", "ACK", 2)])
    assert [r.outcome for r in made.orderBy("at").collect()] == ["accepted", "rejected"]


class _Drawers:
    """Map state that counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def containsKey(self, key):
        self.calls += 1
        return key in self.held

    def getValue(self, key):
        self.calls += 1
        return self.held[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value


class _Handle:
    def __init__(self):
        self.drawers = _Drawers()

    def getMapState(self, *_):
        return self.drawers


def test_a_group_of_alerts_costs_a_call_per_value_of_state_and_not_per_alert():
    clerk, handle = status._Desk(), _Handle()
    clerk.init(handle)
    rows = [(i % status.DRAWERS, f"a{i}", kind, word, 10 + kind) for i in range(4000) for kind, word in ((0, "OPEN"), (1, "ACK"))]
    names = ["drawer", "alert_id", "kind", "status", "at"]
    parts = [pd.DataFrame(rows[k : k + 3000], columns=names) for k in range(0, len(rows), 3000)]
    first = pd.concat(clerk.handleInputRows((7,), iter(parts), None))
    assert len(first) == 4000 and set(first["outcome"]) == {"accepted"} and handle.drawers.calls <= 3 * status.DRAWERS
    again = pd.DataFrame([(5, "a5", 1, "ACK", None), (5, "a5", 1, "RESOLVED", 9), (6, "none", 1, "ACK", 9)], columns=names)
    found = pd.concat(clerk.handleInputRows((7,), iter([again]), None))
    assert found[["alert_id", "old_status", "outcome", "resolved_at"]].astype(object).where(lambda f: f.notna(), None).values.tolist() == [
        ["a5", "ACK", "rejected", None], ["a5", "ACK", "accepted", 9], ["none", None, "not found", None],
    ]
    assert handle.drawers.calls <= 6 * status.DRAWERS


def test_many_alerts_in_several_batches_equal_the_batch_form(spark, desk):
    many = [alert(f"m{i}", ("OPEN", "ACK", "RESOLVED", None)[i % 4]) for i in range(300)]
    first = [ask(f"m{i}", ("ACK", "RESOLVED")[i % 2], i % 5) for i in range(0, 310)]
    second = [ask(f"m{i}", "RESOLVED", 10 + i % 3) for i in range(0, 300, 3)]
    desk(many, first)
    made = desk([], second)
    both = apply_status_updates(spark.createDataFrame(many, ALERT), spark.createDataFrame(first + second, STATUS_UPDATE))
    known = lambda rows: [r for r in rows if int(r[0][1:]) % 4 != 3]  # noqa: E731  an alert without a status is judged as one that takes no request
    assert known(outcomes(made)) == known(outcomes(both.outcomes))
    assert {r.outcome for r in made.collect() if int(r.alert_id[1:]) < 300 and int(r.alert_id[1:]) % 4 == 3} == {"rejected"}

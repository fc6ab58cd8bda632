"""Rules as rows: checks, versions, and equality with the rules in code."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from tests.conftest import T0
from tidewarden.operators.rule_table import (
    MOST_RULES, RULE, compile_rules, default_rule_rows, detect_rule_rows, rule_rows,
)
from tidewarden.operators.rules import detect_rules
from tidewarden.schemas import TELEMETRY_EVENT

MIDDLE = T0 + dt.timedelta(seconds=30)


def rule(name="r", **parts):
    row = {
        "name": name, "metric": "m", "event_type": "metric", "fields": "value DOUBLE", "predicate": "value > 1",
        "score": "value", "severity": "'WARNING'", "description": "'d'", "details": "'{}'", "valid_from": None, "valid_to": None,
    } | parts
    return tuple(row[n] for n in RULE.names)


@pytest.fixture
def check(spark):
    def run(*rows):
        return compile_rules(rule_rows(spark, list(rows)))

    return run


def reasons(made):
    return {r.name: r.reject_reason for r in made.rejected.collect()}


def test_the_default_rows_equal_the_rules_in_code(spark, make_events, check):
    events = make_events(
        {"type": "log", "payload": '{"level": "ERROR", "message": "x"}'},
        {"type": "log", "payload": '{"level": "FATAL"}', "correlation_id": "c"},
        {"type": "log", "payload": '{"level": "INFO"}'},
        {"type": "log", "payload": '{"level": 5}'},
        {"type": "trace", "payload": '{"durationMs": 1000, "operation": "get"}'},
        {"type": "trace", "payload": '{"durationMs": 999.9}'},
        {"type": "trace", "payload": '{"durationMs": 5001.5}'},
        {"type": "trace", "payload": '{"durationMs": 1e300}'},
        {"type": "trace", "payload": '{"durationMs": "1000"}'},
        {"type": "trace", "payload": "no json"},
        {"type": "trace", "payload": None},
    )
    wanted = detect_rules(events)
    found = detect_rule_rows(events, check(*default_rule_rows()))
    assert wanted.count() == 5
    assert found.columns == wanted.columns
    assert wanted.exceptAll(found).count() == 0 == found.exceptAll(wanted).count()


@pytest.mark.parametrize(("parts", "reason"), [
    ({"predicate": "nowhere > 1"}, "predicate: [UNRESOLVED_COLUMN"),
    ({"predicate": "value >"}, "predicate: "),
    ({"predicate": "value"}, "predicate is of type double, not boolean"),
    ({"predicate": "max(value) > 1"}, "predicate: "),
    ({"predicate": None}, "no predicate"),
    ({"score": "'high'"}, "score is of type string, not double"),
    ({"score": "explode(array(1, 2))"}, "score: "),
    ({"score": "sum(value) OVER ()"}, "score: "),
    ({"severity": "1"}, "severity is of type int, not string"),
    ({"details": " "}, "no details"),
    ({"fields": "value NUMBERISH"}, ""),
    ({"fields": ""}, "no fields"),
    ({"fields": "event STRING"}, "a field cannot be called event"),
    ({"fields": "value DOUBLE, Value DOUBLE"}, "a field is declared twice"),
    ({"fields": "value STRING", "predicate": "value > '1'"}, "field value is declared differently by another rule"),
    ({"name": " "}, "no name"),
    ({"event_type": None}, "no event_type"),
    ({"valid_from": MIDDLE, "valid_to": MIDDLE}, "valid_to is not after valid_from"),
])
def test_a_bad_rule_leaves_the_rest_alone(make_events, check, parts, reason):
    bad = rule(**{"name": "zz"} | parts)
    made = check(rule("good"), bad)
    assert [r.name for r in made.rules] == ["good"]
    found = reasons(made)
    assert len(found) == 1 and next(iter(found.values())).startswith(reason)
    events = make_events({"payload": '{"value": 2}'})
    assert [r.detector for r in detect_rule_rows(events, made).collect()] == ["good"]


def test_events_are_judged_by_the_version_of_their_time(make_events, check):
    made = check(
        rule(valid_to=MIDDLE), rule(predicate="value > 5", valid_from=MIDDLE),
        rule("other", predicate="value > 100"),
    )
    assert reasons(made) == {}
    events = make_events(*[{"id": f"{at}/{v}", "at": at, "payload": f'{{"value": {v}}}'} for at in (29, 30, 31) for v in (2, 6)])
    assert {r.event_id for r in detect_rule_rows(events, made).collect()} == {"29/2", "29/6", "30/6", "31/6"}


def test_versions_of_one_rule_do_not_overlap(check):
    made = check(rule(valid_from=MIDDLE), rule(), rule("other"), rule("other", valid_from=T0, valid_to=MIDDLE))
    assert reasons(made) == {"r": "overlaps an earlier version of the rule", "other": "overlaps an earlier version of the rule"}
    assert [(r.name, r.valid_from) for r in made.rules] == [("other", None), ("r", None)]


def test_arithmetic_never_fails_a_job(spark, make_events, check):
    made = check(
        rule("divides", predicate="1 / (value - value) > 0"),
        rule("overflows", predicate="9223372036854775807 + CAST(value AS BIGINT) > 0"),
        rule("casts", predicate="CAST(event.id AS INT) > 0"),
        rule("fires"),
    )
    assert reasons(made) == {}
    found = detect_rule_rows(make_events({"id": "x", "payload": '{"value": 2}'}), made)
    assert [r.detector for r in found.collect()] == ["fires"]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_rules_see_the_event_and_run_on_streams(spark, make_events, check, tmp_path):
    made = check(rule(
        predicate="event.tags['zone'] = 'a'", description="concat(event.source, ' ', event.subtype)",
        details="to_json(named_struct('at', event.ts, 'v', value))",
    ))
    rows = make_events({"tags": {"zone": "a"}, "payload": '{"value": 2}'}, {"tags": {"zone": "b"}}, {})
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(TELEMETRY_EVENT).parquet(str(tmp_path / "in"))
    writer = detect_rule_rows(stream, made).writeStream.format("parquet").trigger(availableNow=True)
    writer.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start().awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.description, r.score, json.loads(r.details)["v"]) for r in found] == [("engine-1 rpm", 2.0, 2.0)]


def test_no_rules_and_too_many(spark, make_events, check):
    none = detect_rule_rows(make_events({}), check())
    assert none.count() == 0 and none.columns == detect_rules(make_events({})).columns
    with pytest.raises(ValueError, match="2000 rows at most"):
        compile_rules(rule_rows(spark, [rule(str(i)) for i in range(MOST_RULES + 1)]))


def test_one_parse_and_no_shuffle(make_events, check):
    made = check(*default_rule_rows(), rule())
    plan = detect_rule_rows(make_events({}), made)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_json") <= 2

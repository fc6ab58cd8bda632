from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.operators import insights
from tidewarden.schemas import ANOMALY_EVENT

GOOD = (
    '{"interpretation": "slow", "classification": " LatencyIssue ", '
    '"probableCauses": ["a", "b"], "recommendations": ["c"]}'
)


@pytest.fixture
def anomalies(spark):
    row = ("a1", "web", "latency", 2.345, "WARNING", "High latency", T0, '{"durationMs":2345}', "c")
    return spark.createDataFrame([row], ANOMALY_EVENT)


def _parse(anomalies, reply):
    text = F.lit(None).cast("string") if reply is None else F.lit(reply)
    return insights.parse_replies(anomalies.withColumn("reply", text)).collect()[0]


def test_good_reply(anomalies):
    row = _parse(anomalies, GOOD)
    assert (row.interpretation, row.incident_classification) == ("slow", "LatencyIssue")
    assert row.probable_causes == ["a", "b"] and row.recommendations == ["c"]
    assert (row.anomaly_id, row.severity, row.score, row.raw_response) == ("a1", "WARNING", 2.345, GOOD)
    assert row.metadata == {"service": "web", "metric": "latency"}


def test_null_fields_get_defaults(anomalies):
    row = _parse(
        anomalies,
        '{"interpretation": null, "classification": null, "probableCauses": null, "recommendations": null}',
    )
    assert (row.interpretation, row.incident_classification) == ("LLM analysis unavailable", "Unknown")
    assert (row.probable_causes, row.recommendations) == (["Unknown"], ["Investigate manually"])


@pytest.mark.parametrize(
    "reply",
    [
        None, "", "  ", "not json", "[1]", "null",
        '{"interpretation": "x"}',
        GOOD[:-1] + ', "extra": 1}',
        GOOD.replace('["a", "b"]', '"a"'),
        GOOD.replace('"slow"', '{"a": 1}'),
        GOOD.replace('["a", "b"]', '[["a"]]'),
    ],
)
def test_unusable_replies_fall_back(anomalies, reply):
    row = _parse(anomalies, reply)
    assert row.interpretation == "LLM service unavailable" and row.raw_response == ""
    assert row.incident_classification == "Unknown"
    assert row.recommendations == ["Ensure Ollama is running and accessible"]


@pytest.mark.parametrize(
    "reply",
    [GOOD.replace('["a", "b"]', "[]"), GOOD.replace('["a", "b"]', '["a", null, 3]'), GOOD.replace('"slow"', "5")],
)
def test_convertible_kinds_are_usable(anomalies, reply):
    assert _parse(anomalies, reply).raw_response == reply


def test_default_scorer(anomalies):
    row = insights.annotate(anomalies).collect()[0]
    assert row.incident_classification == "LatencyIssue" and row.raw_response != ""


def test_batch_scorer_sees_prompts_and_survives_errors(anomalies):
    def model(prompts: pd.Series) -> pd.Series:
        assert prompts.str.contains("SERVICE: web").all()
        return pd.Series([GOOD] * len(prompts))

    assert insights.annotate(anomalies, insights.batch_scorer(model)).collect()[0].interpretation == "slow"

    def broken(prompts: pd.Series) -> pd.Series:
        raise RuntimeError("down")

    row = insights.annotate(anomalies, insights.batch_scorer(broken)).collect()[0]
    assert row.interpretation == "LLM service unavailable"
    assert "reply" not in anomalies.columns


def test_one_failing_prompt_gives_one_fallback(spark, anomalies):
    several = anomalies.crossJoin(spark.range(8).select(F.concat(F.lit("a"), F.col("id")).alias("n")))
    several = several.withColumn("id", F.col("n")).withColumn("service", F.concat(F.lit("s"), F.col("n"))).drop("n")

    def model(prompts: pd.Series) -> pd.Series:
        if prompts.str.contains("SERVICE: sa3").any():
            raise RuntimeError("down")
        return pd.Series([GOOD] * len(prompts), index=prompts.index)

    rows = insights.annotate(several.coalesce(1), insights.batch_scorer(model)).collect()
    assert {r.anomaly_id for r in rows if r.interpretation != "slow"} == {"a3"} and len(rows) == 8


def test_prompt_text(anomalies):
    text = anomalies.select(insights.anomaly_prompt("ru").alias("p")).collect()[0].p
    lines = text.split("\n")
    assert lines[0].endswith("Answer in Russian.")
    assert "ANOMALY SCORE: 2.35" in lines and 'DETAILS: {"durationMs":2345}' in lines
    assert text.count("Russian") == 4


def test_languages():
    assert insights.language_name(None) == "English"
    assert insights.language_name("DE") == "German"
    assert insights.language_name("Klingon") == "Klingon"


def test_log_prompts(make_events):
    frame = make_events(
        {"type": "log", "payload": '{"level": "WARN", "message": "disk"}'}, {"payload": "{}"}
    )
    rows = insights.log_prompts(frame).collect()
    assert len(rows) == 1 and "LEVEL: WARN\nMESSAGE: disk" in rows[0].prompt


def test_fixed_texts_are_spelled_out():
    """The SQL oracles take these texts from the module, so here they stand by themselves."""
    from tidewarden.operators import insights as texts

    assert texts.ANOMALY_PROMPT.splitlines() == [
        "You are an SRE expert analyzing a system anomaly. Answer in %s.", "",
        "SERVICE: %s", "METRIC: %s", "SEVERITY: %s", "ANOMALY SCORE: %.2f", "DESCRIPTION: %s", "DETAILS: %s", "",
        "Respond with a JSON object containing these fields:",
        '- "interpretation": what this anomaly means in plain language (in %s)',
        '- "classification": one of LatencyIssue, ErrorSpike, ThroughputDegradation, ResourceExhaustion, Unknown (in English)',
        '- "probableCauses": array of 2-3 likely root causes (in %s)',
        '- "recommendations": array of 1-2 immediate actions to investigate (in %s)',
    ]
    assert texts.LOG_PROMPT.splitlines() == [
        "You are a systems analyst. Interpret this log entry. Answer in %s.", "",
        "SOURCE: %s", "LEVEL: %s", "MESSAGE: %s", "",
        "Respond with a JSON object containing these fields:",
        '- "impact": what is the likely impact on the system (in %s)',
        '- "escalate": YES or NO (in English)',
        '- "componentToCheck": what component should be checked first (in %s)',
    ]
    assert (texts.NULL_INTERPRETATION, texts.NULL_CLASSIFICATION) == ("LLM analysis unavailable", "Unknown")
    assert (texts.NULL_CAUSES, texts.NULL_RECOMMENDATIONS) == (["Unknown"], ["Investigate manually"])
    assert texts.FALLBACK_INTERPRETATION == "LLM service unavailable"
    assert texts.FALLBACK_CAUSES == ["LLM service unavailable — check Ollama connection"]
    assert texts.FALLBACK_RECOMMENDATIONS == ["Ensure Ollama is running and accessible"]

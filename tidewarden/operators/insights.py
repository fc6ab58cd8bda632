"""Interpretation of anomalies: prompt text, reply parsing, fallback, scorer.

The reply comes from a scorer: a frame-to-frame function that adds a ``reply``
column. The default scorer is a rule expression; a Python model is plugged in with
:func:`batch_scorer`, which Spark runs over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import payload as P
from ..functions.text import has_text, json_object, stable_id, text_or_null

Scorer = Callable[[DataFrame], DataFrame]

# Language codes and the names used in prompts.
LANGUAGES = {
    "en": "English",
    "ru": "Russian",
    "de": "German",
    "fr": "French",
    "es": "Spanish",
    "it": "Italian",
    "pt": "Portuguese",
    "zh": "Chinese",
    "ja": "Japanese",
    "ko": "Korean",
}

# Prompt texts.
ANOMALY_PROMPT = """\
You are an SRE expert analyzing a system anomaly. Answer in %s.

SERVICE: %s
METRIC: %s
SEVERITY: %s
ANOMALY SCORE: %.2f
DESCRIPTION: %s
DETAILS: %s

Respond with a JSON object containing these fields:
- "interpretation": what this anomaly means in plain language (in %s)
- "classification": one of LatencyIssue, ErrorSpike, ThroughputDegradation, ResourceExhaustion, Unknown (in English)
- "probableCauses": array of 2-3 likely root causes (in %s)
- "recommendations": array of 1-2 immediate actions to investigate (in %s)
"""
LOG_PROMPT = """\
You are a systems analyst. Interpret this log entry. Answer in %s.

SOURCE: %s
LEVEL: %s
MESSAGE: %s

Respond with a JSON object containing these fields:
- "impact": what is the likely impact on the system (in %s)
- "escalate": YES or NO (in English)
- "componentToCheck": what component should be checked first (in %s)
"""

# Texts used when a reply field is null, and when there is no usable reply.
NULL_INTERPRETATION = "LLM analysis unavailable"
NULL_CLASSIFICATION = "Unknown"
NULL_CAUSES = ["Unknown"]
NULL_RECOMMENDATIONS = ["Investigate manually"]
FALLBACK_INTERPRETATION = "LLM service unavailable"
FALLBACK_CAUSES = ["LLM service unavailable — check Ollama connection"]
FALLBACK_RECOMMENDATIONS = ["Ensure Ollama is running and accessible"]

REPLY_FIELDS = ["classification", "interpretation", "probableCauses", "recommendations"]


def language_name(code: str | None) -> str:
    """Language for a prompt: unknown codes pass through, none means English."""
    if code is None:
        return "English"
    return LANGUAGES.get(code.lower(), code)


def anomaly_prompt(language: str | None = None) -> Column:
    name = F.lit(language_name(language))
    return F.format_string(
        ANOMALY_PROMPT,
        name, F.col("service"), F.col("metric"), F.col("severity"), F.col("score"),
        text_or_null(F.col("description")), F.coalesce("details", F.lit("")), name, name, name,
    )


def log_prompt(language: str | None = None) -> Column:
    """Prompt for a log event with columns source, level, message."""
    name = F.lit(language_name(language))
    return F.format_string(
        LOG_PROMPT, name, F.col("source"), F.col("level"), F.col("message"), name, name
    )


def log_prompts(events: DataFrame, language: str | None = None) -> DataFrame:
    rows = P.with_fields(events.where(F.col("type") == "log"), P.LOG_FIELDS).select(
        "id", "source", "fields.*"
    )
    return rows.select("id", log_prompt(language).alias("prompt"))


def rule_scorer(anomalies: DataFrame) -> DataFrame:
    """Default scorer: classify by metric name and severity with plain expressions."""
    metric = F.lower("metric")
    kind = (
        F.when(metric == "latency", "LatencyIssue")
        .when(metric == "error-rate", "ErrorSpike")
        .when(metric.rlike("throughput|requests|rps|flow"), "ThroughputDegradation")
        .when(metric.rlike("cpu|memory|disk|heap|temperature|pressure"), "ResourceExhaustion")
        .otherwise("Unknown")
    )
    reply = json_object(
        interpretation=F.concat(
            F.col("metric"), F.lit(" on "), F.col("service"), F.lit(" is outside its usual range")
        ),
        classification=kind,
        probableCauses=F.array(
            F.concat(F.lit("change of load on "), F.col("service")),
            F.concat(F.lit("fault in "), F.col("service")),
        ),
        recommendations=F.array(F.concat(F.lit("inspect "), F.col("metric"), F.lit(" on "), F.col("service"))),
    )
    return anomalies.withColumn("reply", reply)


def _one_reply(score: Callable[[pd.Series], pd.Series], prompt: pd.Series) -> str | None:
    try:
        return score(prompt).iloc[0]
    except Exception:
        return None


def batch_scorer(
    score: Callable[[pd.Series], pd.Series], language: str | None = None
) -> Scorer:
    """Scorer around a Python function from a batch of prompts to a batch of replies.

    Where ``score`` fails for a batch its prompts are scored one by one, and only those
    that fail again get no reply, which leads to the fallback.
    """

    def scorer(anomalies: DataFrame) -> DataFrame:
        asked = anomalies.withColumn("prompt", anomaly_prompt(language))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                try:
                    replies = score(batch["prompt"])
                except Exception:
                    single = [_one_reply(score, batch["prompt"].iloc[i : i + 1]) for i in range(len(batch))]
                    replies = pd.Series(single, index=batch.index, dtype=object)
                yield batch.drop(columns="prompt").assign(reply=replies)

        reply = T.StructField("reply", T.StringType())
        schema = T.StructType([*anomalies.schema.fields, reply])
        return asked.mapInPandas(run, schema)

    return scorer


def _field(name: str) -> Column:
    return F.try_variant_get(F.col("parsed"), f"$.{name}", "variant")


def _usable() -> Column:
    """Exactly the four fields, each null or of a kind that converts to its type."""
    keys = F.array_sort(F.json_object_keys("reply"))
    text_kinds = "^(VOID|STRING|BOOLEAN|BIGINT|DOUBLE|DECIMAL.*)$"
    list_kinds = "^(VOID|ARRAY<(VOID|STRING|BOOLEAN|BIGINT|DOUBLE|DECIMAL[^<]*|VARIANT)>)$"
    texts = [F.schema_of_variant(_field(n)).rlike(text_kinds) for n in ("interpretation", "classification")]
    lists = [F.schema_of_variant(_field(n)).rlike(list_kinds) for n in ("probableCauses", "recommendations")]
    ok = keys == F.array(*[F.lit(n) for n in REPLY_FIELDS])
    for test in [*texts, *lists]:
        ok = ok & test
    return F.coalesce(has_text("reply") & F.col("parsed").isNotNull() & ok, F.lit(False))


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def parse_replies(scored: DataFrame) -> DataFrame:
    """Insights from anomalies with a ``reply`` column.

    A reply that is missing, blank, malformed, incomplete or carries other fields
    gives the fallback insight; a field that is present but null gives its default.
    """
    schema = (
        "interpretation STRING, classification STRING, "
        "probableCauses ARRAY<STRING>, recommendations ARRAY<STRING>"
    )
    judged = (
        scored.withColumn("parsed", F.try_parse_json("reply"))
        .withColumn("usable", _usable())
        .withColumn("fields", F.when(F.col("usable"), F.from_json("reply", schema)))
    )

    def pick(field: Column, default: Column, fallback: Column) -> Column:
        return F.when(F.col("usable"), F.coalesce(field, default)).otherwise(fallback)

    return judged.select(
        stable_id(F.lit("insight"), F.col("id")).alias("id"),
        F.col("id").alias("anomaly_id"),
        "severity",
        "score",
        pick(F.col("fields.interpretation"), F.lit(NULL_INTERPRETATION),
             F.lit(FALLBACK_INTERPRETATION)).alias("interpretation"),
        pick(F.trim("fields.classification"), F.lit(NULL_CLASSIFICATION),
             F.lit("Unknown")).alias("incident_classification"),
        pick(F.col("fields.probableCauses"), _texts(NULL_CAUSES),
             _texts(FALLBACK_CAUSES)).alias("probable_causes"),
        pick(F.col("fields.recommendations"), _texts(NULL_RECOMMENDATIONS),
             _texts(FALLBACK_RECOMMENDATIONS)).alias("recommendations"),
        F.when(F.col("usable"), F.col("reply")).otherwise("").alias("raw_response"),
        F.col("detected_at").alias("analyzed_at"),
        F.create_map(F.lit("service"), F.col("service"), F.lit("metric"), F.col("metric"))
        .alias("metadata"),
    )


def annotate(anomalies: DataFrame, scorer: Scorer = rule_scorer) -> DataFrame:
    """Anomalies to insights through a scorer."""
    return parse_replies(scorer(anomalies))

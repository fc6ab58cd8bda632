"""Stateless threshold rules as data.

A rule is a set of expressions over the parsed payload fields, so new rules are
added to a registry rather than written as code paths. All rules are evaluated in
one pass over the events; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.text import json_object, stable_id, text_or_null, without_id
from ..schemas import CRITICAL, LOG, TRACE, WARNING
from .detect import ANOMALY_COLUMNS

Part = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """``fields`` declares the payload fields; every other part is given their struct."""

    name: str
    metric: str
    event_type: str
    fields: str
    condition: Part
    score: Part
    severity: Part
    description: Part
    details: Part


# Levels that raise the error rule, latency limits in milliseconds.
ERROR_LEVELS = ("ERROR", "FATAL")
LATENCY_MS = 1000
LATENCY_CRITICAL_MS = 5000
LARGEST = 2**63 - 1


def error_rule() -> Rule:
    return Rule(
        name="error-rule",
        metric="error-rate",
        event_type=LOG,
        fields=P.LOG_FIELDS,
        condition=lambda f: f["level"].isin(*ERROR_LEVELS),
        score=lambda f: F.lit(1.0),
        severity=lambda f: F.lit(WARNING),
        description=lambda f: F.format_string("Error detected: %s", text_or_null(f["message"])),
        details=lambda f: json_object(level=f["level"], message=f["message"]),
    )


def latency_rule(limit_ms: int = LATENCY_MS, critical_ms: int = LATENCY_CRITICAL_MS) -> Rule:
    def whole_ms(f: Column) -> Column:
        """Whole milliseconds, held at the ends of BIGINT like a saturating conversion."""
        ms = f["durationMs"]
        return (
            F.when(ms >= F.lit(float(LARGEST)), F.lit(LARGEST))
            .when(ms <= F.lit(float(-LARGEST)), F.lit(-LARGEST - 1))
            .otherwise(ms.cast("bigint"))
        )

    return Rule(
        name="latency-rule",
        metric="latency",
        event_type=TRACE,
        fields=P.TRACE_FIELDS,
        condition=lambda f: whole_ms(f) >= limit_ms,
        score=lambda f: whole_ms(f) / F.lit(1000.0),
        severity=lambda f: F.when(whole_ms(f) > critical_ms, CRITICAL).otherwise(WARNING),
        description=lambda f: F.format_string(
            "High latency: %dms for %s", whole_ms(f), text_or_null(f["operation"])
        ),
        details=lambda f: json_object(durationMs=whole_ms(f), operation=f["operation"]),
    )


def default_rules() -> list[Rule]:
    return [error_rule(), latency_rule()]


def _anomaly(rule: Rule, fields: Column) -> Column:
    """Struct of one rule's anomaly, null where the rule does not fire."""
    made = {
        "id": stable_id(F.lit(rule.name), F.col("source"), F.lit(rule.metric), F.col("event_id"),
                        without_id(F.col("event_id"), "ts", fields)),
        "service": F.col("source"),
        "metric": F.lit(rule.metric),
        "score": rule.score(fields).cast("double"),
        "severity": rule.severity(fields),
        "description": rule.description(fields),
        "detected_at": F.col("ts"),
        "details": rule.details(fields),
        "correlation_id": F.col("correlation_id"),
        "detector": F.lit(rule.name),
        "event_id": F.col("event_id"),
    }
    fires = (F.col("type") == rule.event_type) & rule.condition(fields)
    return F.when(fires, F.struct(*[made[name].alias(name) for name in ANOMALY_COLUMNS]))


def detect_rules(events: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Anomalies of all rules, one row per rule that fires on an event."""
    rules = rules or default_rules()
    parsed = {
        f"fields_{i}": F.when(F.col("type") == rule.event_type, P.read_fields(rule.fields))
        for i, rule in enumerate(rules)
    }
    rows = events.where(F.col("type").isin(*{r.event_type for r in rules})).select(
        F.col("id").alias("event_id"), "source", "type", "ts", "correlation_id",
        *[value.alias(name) for name, value in parsed.items()],
    )
    found = F.array_compact(
        F.array(*[_anomaly(rule, F.col(name)) for rule, name in zip(rules, parsed, strict=True)])
    )
    return rows.select(F.explode(found).alias("anomaly")).select("anomaly.*")


def apply_rule(events: DataFrame, rule: Rule) -> DataFrame:
    return detect_rules(events, [rule])

"""Requests to telemetry events: defaults, validation, projection.

Each request kind has a rule table (what must be filled) and a projection.
Invalid rows never fail a job: they come back with their reasons.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text, is_filled, iso_instant, json_object, stable_id
from ..schemas import LOG, METRIC, OPEN, TRACE, WARNING


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


# Fields each request must fill (text), and fields that must not be null.
REQUIRED_TEXT = {
    "event": ["source", "type"],
    "log": ["source", "level", "message"],
    "metric": ["source", "name"],
    "trace": ["traceId", "spanId", "service", "operation"],
}
REQUIRED_VALUE = {"event": [], "log": [], "metric": ["value"], "trace": ["durationMs"]}


def request_rules(kind: str) -> dict[str, Column]:
    """Reason -> condition that must hold."""
    rules = {f"{name} is blank": is_filled(name) for name in REQUIRED_TEXT[kind]}
    rules |= {f"{name} is missing": F.col(name).isNotNull() for name in REQUIRED_VALUE[kind]}
    return rules


def event_rules() -> dict[str, Column]:
    """What any telemetry event must satisfy, whichever way it came in."""
    return {"source is blank": has_text("source"), "type is blank": has_text("type")}


def _reasons(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(~_holds(ok), F.lit(why)) for why, ok in rules.items()]))


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> Split:
    """Two lazy frames over the same rows: the valid ones, and the rejects with reasons."""
    good = F.lit(True)
    for condition in rules.values():
        good = good & _holds(condition)
    return Split(df.where(good), df.where(~good).withColumn("reject_reasons", _reasons(rules)))


def _optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _project(df: DataFrame, kind: str, fields: dict[str, Column], as_of: Column | None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    ts_type = df.schema["timestamp"].dataType
    fields = {**fields, "ts": F.coalesce(F.col("timestamp"), now.cast(ts_type))}
    content = stable_id(
        F.lit(kind),
        *[F.coalesce(F.to_json(F.struct(F.col(c))), F.lit("")) for c in sorted(df.columns)],
    )
    given = F.col("id") if "id" in df.columns else F.lit(None).cast("string")
    order = ["id", "source", "type", "subtype", "payload", "ts", "correlation_id", "tags"]
    fields["id"] = F.when(has_text(given), given).otherwise(content)
    return df.select(*[fields[name].alias(name) for name in order])


def normalize_event(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Generic request: everything passes through, a missing payload becomes ``{}``."""
    return _project(
        df,
        "event",
        {
            "source": F.col("source"),
            "type": F.col("type"),
            "subtype": F.col("subtype"),
            "payload": F.coalesce("payload", F.lit("{}")),
            "correlation_id": F.col("correlationId"),
            "tags": F.col("tags"),
        },
        as_of,
    )


def normalize_log(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Log request: the level names the subtype; the request's own ``service`` is not used."""
    return _project(
        df,
        LOG,
        {
            "source": F.col("source"),
            "type": F.lit(LOG),
            "subtype": F.lower("level"),
            "payload": json_object(level=F.col("level"), message=F.col("message")),
            "correlation_id": F.col("correlationId"),
            "tags": F.col("tags"),
        },
        as_of,
    )


def normalize_metric(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Metric request: never correlated."""
    return _project(
        df,
        METRIC,
        {
            "source": F.col("source"),
            "type": F.lit(METRIC),
            "subtype": F.col("name"),
            "payload": json_object(metric=F.col("name"), value=F.col("value")),
            "correlation_id": F.lit(None).cast("string"),
            "tags": F.col("tags"),
        },
        as_of,
    )


def normalize_trace(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Trace request: the service is the source, the trace id correlates."""
    start = _optional(df, "startTime", "timestamp")
    return _project(
        df,
        TRACE,
        {
            "source": F.col("service"),
            "type": F.lit(TRACE),
            "subtype": F.col("operation"),
            "payload": json_object(
                traceId=F.col("traceId"),
                spanId=F.col("spanId"),
                parentSpanId=F.coalesce(F.col("parentSpanId"), F.lit("")),
                operation=F.col("operation"),
                durationMs=F.col("durationMs"),
                startTime=F.coalesce(iso_instant(start), F.lit("")),
            ),
            "correlation_id": F.col("traceId"),
            "tags": F.create_map(F.lit("service"), F.col("service")),
        },
        as_of,
    )


NORMALIZERS = {
    "event": normalize_event,
    "log": normalize_log,
    "metric": normalize_metric,
    "trace": normalize_trace,
}


def ingest(df: DataFrame, kind: str, as_of: Column | None = None) -> Split:
    """Validate one kind of request and normalise what passes."""
    judged = split_valid(df, request_rules(kind))
    events = split_valid(NORMALIZERS[kind](judged.valid, as_of), event_rules())
    return Split(events.valid, judged.rejected)


def with_anomaly_defaults(df: DataFrame, as_of: Column) -> DataFrame:
    """Severity WARNING and detection time ``as_of`` where missing."""
    return df.withColumns(
        {
            "severity": F.coalesce("severity", F.lit(WARNING)),
            "detected_at": F.coalesce("detected_at", as_of),
        }
    )


def with_alert_defaults(df: DataFrame, as_of: Column) -> DataFrame:
    """Anomaly defaults plus status OPEN."""
    return with_anomaly_defaults(df, as_of).withColumn("status", F.coalesce("status", F.lit(OPEN)))

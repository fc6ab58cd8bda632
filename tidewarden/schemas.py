"""Declared schemas and fixed vocabulary of the telemetry model.

Nothing is inferred from data: every source declares one of these types.
``payload`` and ``details`` are open objects and stay JSON text at rest.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_TS = T.TimestampType()
_TAGS = T.MapType(_S, _S)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


TELEMETRY_EVENT = _struct(
    ("id", _S),
    ("source", _S),
    ("type", _S),
    ("subtype", _S),
    ("payload", _S),
    ("ts", _TS),
    ("correlation_id", _S),
    ("tags", _TAGS),
)

ENRICHED_EVENT = _struct(
    ("original", TELEMETRY_EVENT),
    ("window_start", _TS),
    ("window_end", _TS),
    (
        "enrichment_metadata",
        _struct(("correlatedCount", T.LongType()), ("uniqueServices", T.IntegerType())),
    ),
)

ANOMALY_EVENT = _struct(
    ("id", _S),
    ("service", _S),
    ("metric", _S),
    ("score", T.DoubleType()),
    ("severity", _S),
    ("description", _S),
    ("detected_at", _TS),
    ("details", _S),
    ("correlation_id", _S),
)

INSIGHT = _struct(
    ("id", _S),
    ("anomaly_id", _S),
    ("severity", _S),
    ("score", T.DoubleType()),
    ("interpretation", _S),
    ("incident_classification", _S),
    ("probable_causes", T.ArrayType(_S)),
    ("recommendations", T.ArrayType(_S)),
    ("raw_response", _S),
    ("analyzed_at", _TS),
    ("metadata", _TAGS),
)

ALERT = _struct(
    ("id", _S),
    ("title", _S),
    ("severity", _S),
    ("status", _S),
    ("source", _S),
    ("description", _S),
    ("recommendation", _S),
    ("anomaly_id", _S),
    ("detected_at", _TS),
    ("resolved_at", _TS),
)

STATUS_UPDATE = _struct(("alert_id", _S), ("new_status", _S), ("at", _TS))

METRIC_POINT = _struct(
    ("time", _TS),
    ("id", _S),
    ("service", _S),
    ("metric_name", _S),
    ("value", T.DoubleType()),
    ("tags", _TAGS),
)

EVENT_REQUEST = _struct(
    ("source", _S),
    ("type", _S),
    ("subtype", _S),
    ("payload", _S),
    ("correlationId", _S),
    ("tags", _TAGS),
    ("timestamp", _TS),
)

LOG_REQUEST = _struct(
    ("source", _S),
    ("level", _S),
    ("message", _S),
    ("service", _S),
    ("correlationId", _S),
    ("tags", _TAGS),
    ("timestamp", _TS),
)

METRIC_REQUEST = _struct(
    ("source", _S),
    ("name", _S),
    ("value", T.DoubleType()),
    ("tags", _TAGS),
    ("timestamp", _TS),
)

TRACE_REQUEST = _struct(
    ("traceId", _S),
    ("spanId", _S),
    ("parentSpanId", _S),
    ("service", _S),
    ("operation", _S),
    ("durationMs", T.LongType()),
    ("startTime", _TS),
    ("timestamp", _TS),
)

TERMO_CSV = _struct(
    ("packet_id", T.LongType()),
    ("event_time", _TS),
    ("tr_id", T.LongType()),
    ("unit_id", T.LongType()),
    ("sensor_id", T.LongType()),
    ("val", T.DoubleType()),
    ("status", T.IntegerType()),
)

FUEL_CSV = _struct(
    ("packet_id", T.LongType()),
    ("event_time", _TS),
    ("sensor_id", T.LongType()),
    ("tr_id", T.LongType()),
    ("level_mm", T.DoubleType()),
    ("level_l", T.DoubleType()),
    ("temperature", T.DoubleType()),
    ("switched_on", T.BooleanType()),
)

# Topic names and their partition counts.
TOPICS = {
    "raw-events": 3,
    "enriched-events": 3,
    "anomaly-events": 2,
    "llm-insights": 2,
    "alerts": 1,
    "alerts-broadcast": 1,
}

# Words used in the type, severity and status columns.
METRIC, LOG, TRACE = "metric", "log", "trace"
WARNING, CRITICAL = "WARNING", "CRITICAL"
OPEN, ACK, RESOLVED = "OPEN", "ACK", "RESOLVED"

# Defaults of the listing and rollup calls.
DEFAULT_LIMIT = 100
DEFAULT_BUCKET = "1 minute"

"""JSON wire records: decode with a declared schema, encode with topic keys.

The functions work on any frame with a ``value`` column, so the same code serves
files, tables and Kafka; :func:`kafka_stream` and :func:`kafka_sink` only add the
connector options (its package has to be on the session's class path).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.payload import parse_once
from ..functions.text import iso_instant
from ..operators.normalize import Split, event_rules, split_valid
from ..schemas import ANOMALY_EVENT, ENRICHED_EVENT, INSIGHT, TELEMETRY_EVENT

_BROKEN = "_broken"

# Field names on the wire and the columns they become.
EVENT_NAMES = {
    "id": "id", "source": "source", "type": "type", "subtype": "subtype", "payload": "payload",
    "timestamp": "ts", "correlationId": "correlation_id", "tags": "tags",
}
ENRICHED_NAMES = {
    "original": "original", "windowStart": "window_start",
    "windowEnd": "window_end", "enrichmentMetadata": "enrichment_metadata",
}
ANOMALY_NAMES = {
    "id": "id", "service": "service", "metric": "metric", "score": "score",
    "severity": "severity", "description": "description", "detectedAt": "detected_at",
    "details": "details", "correlationId": "correlation_id",
}
INSIGHT_NAMES = {
    "id": "id", "anomalyId": "anomaly_id", "severity": "severity", "score": "score",
    "interpretation": "interpretation", "incidentClassification": "incident_classification",
    "probableCauses": "probable_causes", "recommendations": "recommendations",
    "rawLlmResponse": "raw_response", "analyzedAt": "analyzed_at", "metadata": "metadata",
}


def _wire_schema(schema: T.StructType, names: dict[str, str]) -> T.StructType:
    fields = []
    for wire, column in names.items():
        kind = schema[column].dataType
        if column == "original":
            kind = _wire_schema(TELEMETRY_EVENT, EVENT_NAMES)
        fields.append(T.StructField(wire, kind, True))
    return T.StructType(fields)


def non_empty(messages: DataFrame) -> DataFrame:
    """Drop messages without a value."""
    return messages.where(F.length("value") > 0)


def decode(
    messages: DataFrame, schema: T.StructType, names: dict[str, str],
    rules: dict[str, Column] | None = None,
) -> Split:
    """Typed rows, and the messages that are no such record (with reasons).

    ``rules`` are further conditions on the decoded columns.
    """
    wire = _wire_schema(schema, names).add(_BROKEN, T.StringType())
    text = F.col("value").cast("string")
    record = F.from_json(text, wire, {"columnNameOfCorruptRecord": _BROKEN})
    rows = parse_once(non_empty(messages).select(text.alias("value")), record, "record").select(
        "value", _is_whole("record").alias("whole"),
        *[F.col(f"record.{name}").alias(column) for name, column in names.items()],
    )
    further = {why: ok | ~F.col("whole") for why, ok in (rules or {}).items()}
    judged = split_valid(rows, {"malformed JSON": F.col("whole"), **further})
    return Split(
        judged.valid.select(*names.values()), judged.rejected.select("value", "reject_reasons")
    )


def _is_whole(record: str) -> Column:
    return F.col(f"{record}.{_BROKEN}").isNull() & F.col(record).isNotNull()


def decode_events(messages: DataFrame, as_of: Column | None = None) -> Split:
    """Telemetry events; a missing time becomes ``as_of``, blank source or type is rejected."""
    decoded = decode(messages, TELEMETRY_EVENT, EVENT_NAMES, event_rules())
    now = F.current_timestamp() if as_of is None else as_of
    return Split(decoded.valid.withColumn("ts", F.coalesce("ts", now)), decoded.rejected)


def decode_enriched(messages: DataFrame) -> Split:
    decoded = decode(messages, ENRICHED_EVENT, ENRICHED_NAMES)
    original = F.struct(
        *[F.col(f"original.{wire}").alias(column) for wire, column in EVENT_NAMES.items()]
    )
    return Split(decoded.valid.withColumn("original", original), decoded.rejected)


def decode_anomalies(messages: DataFrame) -> Split:
    return decode(messages, ANOMALY_EVENT, ANOMALY_NAMES)


def decode_insights(messages: DataFrame) -> Split:
    return decode(messages, INSIGHT, INSIGHT_NAMES)


def _wire_value(df: DataFrame, names: dict[str, str], prefix: str = "") -> Column:
    """Struct with wire names; times as ISO text, open objects as JSON, not as quoted text."""
    schema = df.select(f"{prefix}*").schema if prefix else df.schema
    parts = []
    for wire, column in names.items():
        value = F.col(prefix + column)
        if column == "original":
            value = _wire_value(df, EVENT_NAMES, "original.")
        elif isinstance(schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
            value = iso_instant(value)
        elif column in ("payload", "details"):
            value = F.try_parse_json(value)
        parts.append(value.alias(wire))
    return F.struct(*parts)


def encode(df: DataFrame, names: dict[str, str], key: Column) -> DataFrame:
    """Message frame with string ``key`` and JSON ``value``."""
    value = F.to_json(_wire_value(df, names), {"ignoreNullFields": "false"})
    return df.select(key.cast("string").alias("key"), value.alias("value"))


def encode_events(events: DataFrame) -> DataFrame:
    """Keyed by source and type."""
    return encode(events, EVENT_NAMES, F.concat_ws(":", "source", "type"))


def encode_enriched(enriched: DataFrame) -> DataFrame:
    """Keyed by correlation id; input as from ``correlate.enriched_record``."""
    return encode(enriched, ENRICHED_NAMES, F.col("original.correlation_id"))


def encode_members(chunks: DataFrame) -> DataFrame:
    """Records of ``correlate.member_chunks``, keyed by correlation id like their events."""
    names = {
        "correlationId": "correlation_id", "windowStart": "window_start",
        "windowEnd": "window_end", "chunk": "chunk", "members": "members",
    }
    return encode(chunks, names, F.col("correlation_id"))


def encode_anomalies(anomalies: DataFrame) -> DataFrame:
    """Keyed by service and metric."""
    return encode(anomalies, ANOMALY_NAMES, F.concat_ws(":", "service", "metric"))


def encode_insights(insights: DataFrame) -> DataFrame:
    """Keyed by anomaly id."""
    return encode(insights, INSIGHT_NAMES, F.col("anomaly_id"))


def encode_notices(notices: DataFrame) -> DataFrame:
    """Alert notices, keyed by alert id."""
    return encode(notices, {name: name for name in notices.columns}, F.col("id"))


def json_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of newline-separated JSON messages from a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Stream of one topic from its earliest offset."""
    settings = {"startingOffsets": "earliest", **options}
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**settings)
        .load()
    )


def kafka_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )

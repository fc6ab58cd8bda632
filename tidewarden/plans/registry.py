"""Named queries over the supplied tables, one or more per operator."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import bucket_start
from ..functions.text import json_object
from ..operators import alert_stats, alerts, correlate, detect, insights, minutes, normalize, rollup, rules, search
from ..operators import rule_table as rule_tables
from ..schemas import METRIC_POINT
from ..sources import compaction, json_arrays, requests, sensors, store, text_index, wire
from ..session import fresh_folder
from ..streaming import status, streams, windows
from .streams_over_tables import events_stream
from .views import k_of_props, log_level, table, telemetry, telemetry_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ALERT_SERVICES = 40


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _round(name: str) -> Column:
    """Six decimals; the shift keeps exact ties on one side whatever the order of summation."""
    return _six(F.col(name)).alias(name)


def _six(value: Column) -> Column:
    return F.round(value + F.lit(1e-9), 6)


STATS_AS_OF = "2024-01-15 12:00:00"
STORE_AS_OF = "2024-01-30 20:00:00"


# Detectors -------------------------------------------------------------------


def _anomaly_view(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        "id", "service", "metric", _round("score"), "severity",
        F.col("detected_at").cast("timestamp_ntz").alias("detected_at"),
        "correlation_id", "detector", "event_id",
    )


@_query
def raw_zscore_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _anomaly_view(detect.detect_raw(telemetry(spark, folder), "1 day"))


@_query
def raw_zscore_weekly(spark: SparkSession, folder: str) -> DataFrame:
    return _anomaly_view(detect.detect_raw(telemetry(spark, folder), "7 days"))


@_query
def raw_zscore_two_step(spark: SparkSession, folder: str) -> DataFrame:
    return _anomaly_view(detect.detect_raw(telemetry(spark, folder), "1 day", strategy="adaptive"))


@_query
def raw_zscore_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Scores from exact sums, the events dealt to other partitions before."""
    events = telemetry(spark, folder).repartition("subtype", "source")
    return _anomaly_view(detect.detect_raw(events, "1 day", strategy="exact"))


@_query
def window_statistics_daily(spark: SparkSession, folder: str) -> DataFrame:
    stats = detect.window_stats(detect.windowed_samples(telemetry(spark, folder), "1 day"))
    return stats.select(
        "window_start", "source", "metric", "events", "samples", _round("mean"), _round("stddev")
    )


def _context_view(found: DataFrame) -> DataFrame:
    context = F.from_json(
        "details", "zScore DOUBLE, windowSize BIGINT, correlatedCount BIGINT, uniqueServices BIGINT"
    )
    return found.withColumn("context", context).select(
        "id", "service", "metric", _round("score"), "severity", "correlation_id", "event_id",
        F.col("context.windowSize").alias("window_size"),
        F.col("context.correlatedCount").alias("correlated_count"),
        F.col("context.uniqueServices").alias("unique_services"),
        _six(F.col("context.zScore")).alias("z_score"),
    )


@_query
def enriched_zscore_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _context_view(detect.detect_enriched(telemetry(spark, folder), "1 day"))


@_query
def enriched_context_links(spark: SparkSession, folder: str) -> DataFrame:
    events = correlate.correlated(telemetry(spark, folder))
    samples = detect.windowed_samples(events, "1 day")
    links = correlate.context_links(detect.firing_groups(samples), samples)
    return links.select("window_start", "source", "metric", "correlation_id")


@_query
def enriched_context_services(spark: SparkSession, folder: str) -> DataFrame:
    events = correlate.correlated(telemetry(spark, folder))
    samples = detect.windowed_samples(events, "1 day")
    links = correlate.context_links(detect.firing_groups(samples), samples)
    services = correlate.correlation_services(events, "1 day")
    return correlate.context_services(links, services).select("window_start", "source", "metric", "service")


@_query
def correlation_chunks_ordered(spark: SparkSession, folder: str) -> DataFrame:
    """Members of weekly groups in order of time and id, four to a record."""
    rows = correlate.ordered_member_chunks(telemetry(spark, folder), "7 days", length=4)
    return rows.select(
        "window_start", "correlation_id", "chunk",
        F.array_join(F.transform("members", lambda m: m["member_id"]), ",").alias("members"),
    )


@_query
def context_id_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted distinct ids behind every firing metric group, ten to a record."""
    events = correlate.correlated(telemetry(spark, folder))
    samples = detect.windowed_samples(events, "1 day")
    links = correlate.context_links(detect.firing_groups(samples), samples)
    rows = correlate.context_id_chunks(links, events, "1 day", length=10)
    return rows.select("window_start", "source", "metric", "chunk", F.array_join("ids", ",").alias("ids"))


def _planted(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry in which some metrics are infinite and some durations beyond any integer."""
    number = F.substring("id", 5, 20).cast("bigint")
    infinite = F.concat(F.lit('{"metric": "'), F.col("subtype"), F.lit('", "value": 1e999}'))
    huge = F.lit('{"operation": "purchase", "durationMs": 1e30}')
    return telemetry(spark, folder).withColumn(
        "payload",
        F.when((F.col("type") == "metric") & (number % 101 == 0), infinite)
        .when((F.col("type") == "trace") & (number % 7 == 0), huge)
        .otherwise(F.col("payload")),
    )


@_query
def planted_infinity_zscore(spark: SparkSession, folder: str) -> DataFrame:
    return _anomaly_view(detect.detect_raw(_planted(spark, folder), "1 day"))


@_query
def planted_huge_latency(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.apply_rule(_planted(spark, folder), rules.latency_rule())
    fields = F.from_json("details", "durationMs BIGINT")
    return found.select("id", "severity", fields["durationMs"].alias("duration_ms"))


@_query
def planted_infinity_rollup(spark: SparkSession, folder: str) -> DataFrame:
    points = rollup.metric_points(_planted(spark, folder)).points
    rows = rollup.metric_rollup(points, "1 day", inline_values=20)
    return rows.select("bucket", "service", "metric_name", "min", "max", "cnt")


@_query
def rule_error(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.apply_rule(telemetry(spark, folder), rules.error_rule())
    level = F.from_json("details", "level STRING, message STRING")
    return found.select(
        "id", "service", "metric", "score", "severity", "description", "detected_at",
        "correlation_id", level["level"].alias("level"), level["message"].alias("message"),
    )


@_query
def rule_latency(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.apply_rule(telemetry(spark, folder), rules.latency_rule())
    fields = F.from_json("details", "durationMs BIGINT, operation STRING")
    return found.select(
        "id", "service", "metric", _round("score"), "severity", "description", "detected_at",
        "correlation_id", fields["durationMs"].alias("duration_ms"),
        fields["operation"].alias("operation"),
    )


@_query
def rule_table(spark: SparkSession, folder: str) -> DataFrame:
    """Both rules from rows, beside one with an unknown field and one that divides by zero."""
    unknown = ("unknown-field", "m", "trace", "operation STRING", "nowhere > 1", "1.0D", "'WARNING'", "'d'", "'{}'", None, None)
    divides = ("divides", "m", "trace", "durationMs DOUBLE", "1 / (durationMs - durationMs) > 0", "1.0D", "'WARNING'", "'d'", "'{}'", None, None)
    rows = rule_tables.rule_rows(spark, [*rule_tables.default_rule_rows(), unknown, divides])
    found = rule_tables.detect_rule_rows(telemetry(spark, folder), rule_tables.compile_rules(rows))
    return found.select(
        "id", "service", "metric", _round("score"), "severity", "description",
        F.col("detected_at").cast("timestamp_ntz").alias("detected_at"), "correlation_id", "detector", "event_id",
    )


RULE_CHANGE = "2024-01-15 00:00:00"


@_query
def rule_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A latency rule whose limits rise in the middle of the month, and a rule on the event's own columns."""
    slow = rule_tables.default_rule_rows()[1]
    change = dt.datetime.fromisoformat(RULE_CHANGE)
    before = (*slow[:9], None, change)
    after = tuple(part.replace(">= 1000", ">= 1500").replace("> 5000", "> 1800") for part in slow[:9])
    busy = (
        "busy", "load", "metric", "value DOUBLE", "value > 90 AND event.source = 'svc-1' AND event.tags['k'] = '3'", "value",
        "if(value > 99, 'CRITICAL', 'WARNING')", "concat_ws(' ', event.subtype, event.id)", "to_json(named_struct('value', value))",
        None, None,
    )
    rows = rule_tables.rule_rows(spark, [(*after, change, None), before, busy])
    found = rule_tables.detect_rule_rows(telemetry(spark, folder), rule_tables.compile_rules(rows))
    return found.select("service", "metric", _round("score"), "severity", "description", "detector", "event_id")


@_query
def anomaly_union(spark: SparkSession, folder: str) -> DataFrame:
    events = telemetry(spark, folder)
    return _anomaly_view(
        detect.union_anomalies(
            detect.detect_enriched(events, "1 day"),
            rules.detect_rules(events),
            detect.detect_raw(events, "1 day"),
        )
    )


@_query
def anomaly_description(spark: SparkSession, folder: str) -> DataFrame:
    found = detect.detect_raw(telemetry(spark, folder), "1 day")
    details = F.from_json("details", "value DOUBLE, mean DOUBLE, stddev DOUBLE, windowSize BIGINT")
    return found.withColumn("parts", details).select(
        "id", "description", F.col("parts.value").alias("value"),
        _six(F.col("parts.mean")).alias("mean"), _six(F.col("parts.stddev")).alias("stddev"),
        F.col("parts.windowSize").alias("window_size"),
    )


# Correlation -----------------------------------------------------------------


def _correlate_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "correlation_id",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "correlated_count",
        "unique_services",
    )


@_query
def correlate_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _correlate_view(correlate.correlate(telemetry(spark, folder), "1 day"))


@_query
def correlation_groups_daily(spark: SparkSession, folder: str) -> DataFrame:
    groups = correlate.correlation_groups(telemetry(spark, folder, services=7), "1 day")
    return groups.select(
        "window_start", "window_end", "correlation_id", "correlated_count", "unique_services"
    )


@_query
def correlation_services_daily(spark: SparkSession, folder: str) -> DataFrame:
    found = correlate.correlation_services(telemetry(spark, folder, services=7), "1 day")
    return found.select("window_start", "correlation_id", F.col("source").alias("service"), "events")


@_query
def correlation_chunks_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The members of all groups out of records of about three ids."""
    chunks = correlate.member_chunks(telemetry(spark, folder), "1 day", length=3)
    return chunks.select("window_start", "correlation_id", F.explode("members").alias("m")).select(
        "window_start", "correlation_id", "m.member_id", "m.copies"
    )


@_query
def correlation_members_daily(spark: SparkSession, folder: str) -> DataFrame:
    members = correlate.correlation_members(telemetry(spark, folder), "1 day")
    return members.select("window_start", "correlation_id", "member_id", "copies", "first_ts")


# Metric store and search -----------------------------------------------------


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.metric_points(telemetry(spark, folder)).points


def _rollup_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        "bucket", "service", "metric_name", _round("avg"), "min", "max",
        _round("p95"), _round("p99"), "cnt",
    )


@_query
def metric_points(spark: SparkSession, folder: str) -> DataFrame:
    return _points(spark, folder).select(
        "time", "id", "service", "metric_name", "value",
        F.try_element_at("tags", F.lit("k")).alias("tag_k"),
    )


@_query
def metric_rollup_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return _rollup_view(rollup.metric_rollup(_points(spark, folder), "1 hour"))


@_query
def metric_rollup_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _rollup_view(rollup.metric_rollup(_points(spark, folder), "1 day"))


@_query
def metric_rollup_weekly(spark: SparkSession, folder: str) -> DataFrame:
    return _rollup_view(rollup.metric_rollup(_points(spark, folder), "7 days"))


@_query
def metric_rollup_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _rollup_view(rollup.metric_rollup(_points(spark, folder), "1 month"))


@_query
def metric_rollup_large_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The rank search that large groups take, here for every group above 50 values."""
    return _rollup_view(rollup.metric_rollup(_points(spark, folder), "7 days", inline_values=50))


@_query
def metric_rollup_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as metric points: a month of prices per return flag and line status."""
    points = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("time"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_returnflag").alias("service"),
        F.col("l_linestatus").alias("metric_name"),
        F.col("l_extendedprice").cast("double").alias("value"),
    )
    return _rollup_view(rollup.metric_rollup(points, "1 month"))


@_query
def rollup_from_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly rollup from rows per minute; of the percentiles it is compared whether their rank is
    within the stated error."""
    points = _points(spark, folder)
    made = minutes.merged_rollup(minutes.base_rows(points), "7 days")
    week = bucket_start(F.col("time"), "7 days").cast("timestamp_ntz").alias("bucket")
    values = points.select(week, "service", "metric_name", "value")
    keys = ["bucket", "service", "metric_name"]
    below = lambda p: (F.sum((F.col("value") < F.col(p)).cast("long")) / F.count(F.lit(1)))
    upto = lambda p: (F.sum((F.col("value") <= F.col(p)).cast("long")) / F.count(F.lit(1)))
    near = [
        ((below(p) <= share + F.max("rank_error")) & (upto(p) >= share - F.max("rank_error"))).alias(f"{p}_near")
        for p, share in (("p95", 0.95), ("p99", 0.99))
    ]
    checked = values.join(made.select(*keys, "p95", "p99", "rank_error"), keys).groupBy(*keys).agg(*near)
    return made.join(checked, keys).select(*keys, _round("avg"), "min", "max", "cnt", "p95_near", "p99_near")


@_query
def metric_rollup_latest(spark: SparkSession, folder: str) -> DataFrame:
    rows = rollup.latest_rollup(
        _points(spark, folder), "1 hour", limit=50, service="svc-1", metric_name=" ",
        start=_at("2024-01-02 00:00:00"), end=_at("2024-01-20 00:00:00"),
    )
    return _rollup_view(rows)


@_query
def event_search(spark: SparkSession, folder: str) -> DataFrame:
    found = search.search_events(
        telemetry(spark, folder), type="log", text='ERROR%"k\\\\": 1', limit=0,
        start=_at("2024-01-03 00:00:00"), end=_at("2024-01-25 00:00:00"),
    )
    return found.select("id", "source", "type", "subtype", "ts", "correlation_id")


@_query
def event_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Text search without a limit; ``7_`` also matches inside tags."""
    found = search.match_events(telemetry(spark, folder), text='"7_"', source="svc-0")
    return found.select("id", "source", "type", "ts")


@_query
def indexed_search(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows from a store, through its text index; one batch comes after the indexing."""
    root = fresh_folder(spark, "indexed")
    events = telemetry(spark, folder)
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    store.write_batch(events.where(~late), root, 0, _at(STORE_AS_OF))
    text_index.update_index(spark, root)
    store.write_batch(events.where(late), root, 1, _at(STORE_AS_OF))
    found = text_index.indexed_matches(spark, root, 'k":"7_"', source="svc-0")
    return found.select("id", "source", "type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@_query
def conversation_search(spark: SparkSession, folder: str) -> DataFrame:
    """Whole conversation texts as log payloads, searched case-sensitively."""
    turns = table(spark, folder, "conversations").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("id"),
        F.col("role").alias("source"), F.lit("log").alias("type"), F.col("role").alias("subtype"),
        F.col("text").alias("payload"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.lit(None).cast("map<string,string>").alias("tags"),
    )
    return search.match_events(turns, text="the%a").select("id", "source")


@_query
def storage_summary(spark: SparkSession, folder: str) -> DataFrame:
    return search.storage_summary(
        telemetry(spark, folder), _points(spark, folder), _at(STORE_AS_OF)
    )


@_query
def latest_event(spark: SparkSession, folder: str) -> DataFrame:
    """Every event written twice; the second writing wins where its turn comes later."""
    events = telemetry(spark, folder).withColumn("received_at", F.col("ts"))
    again = events.withColumns(
        {
            "received_at": F.when(F.col("tags")["k"].cast("bigint") % 2 == 0,
                                  F.col("ts") + F.expr("INTERVAL 1 HOUR"))
            .otherwise(F.col("ts") - F.expr("INTERVAL 1 HOUR")),
            "subtype": F.concat(F.col("subtype"), F.lit("-again")),
        }
    )
    current = store.current_events(events.unionByName(again))
    return current.select("id", "subtype", "received_at")


def _stored(spark: SparkSession, folder: str, again: bool) -> str:
    """A store that holds the events of the table; ``again`` delivers all of them once more,
    every second one changed."""
    home = fresh_folder(spark, "store")
    events = telemetry(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    store.write_batch(events, home, 0, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    if again:
        changed = F.when(F.col("tags")["k"].cast("bigint") % 2 == 0, F.concat("subtype", F.lit("-again")))
        later = events.withColumn("subtype", F.coalesce(changed, F.col("subtype")))
        store.write_batch(later, home, 1, F.lit("2024-02-01 00:00:01").cast("timestamp"))
    return home


@_query
def store_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = store.read_events(spark, _stored(spark, folder, again=False))
    ts = F.col("ts").cast("timestamp_ntz").alias("ts")
    return rows.select("id", "source", "type", "subtype", ts, "correlation_id")


@_query
def store_redelivery(spark: SparkSession, folder: str) -> DataFrame:
    return store.read_events(spark, _stored(spark, folder, again=True)).select("id", "subtype")


@_query
def store_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Events stored in four batches; three are compacted, one of them is retried afterwards, one
    comes later, and what the compaction covers is deleted."""
    root = fresh_folder(spark, "compacted")
    events = telemetry(spark, folder)
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    part = F.pmod(F.xxhash64("id"), F.lit(4))
    for number in (0, 1, 2):
        store.write_batch(events.where(part == number), root, number, _at(STORE_AS_OF))
    store.compact(spark, root, up_to=2, least_batches=2, rows_per_file=20_000)
    store.write_batch(events.where(part == 1), root, 1, _at(STORE_AS_OF))
    store.write_batch(events.where(part == 3), root, 3, _at(STORE_AS_OF))
    for name, schema in (("events", store.EVENT_ROWS), ("points", METRIC_POINT)):
        compaction.drop_covered(spark, f"{root}/{name}", schema)
    found = store.read_events(spark, root).select("id", "source", "type", "subtype", "correlation_id", "ts")
    points = store.read_points(spark, root).select(F.regexp_replace("id", "-m$", "").alias("id"), "metric_name", "value")
    return found.join(points, "id", "left").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@_query
def store_points(spark: SparkSession, folder: str) -> DataFrame:
    rows = store.read_points(spark, _stored(spark, folder, again=False))
    return rows.select(F.col("time").cast("timestamp_ntz").alias("time"), "id", "service", "metric_name", "value")


# Ingest ----------------------------------------------------------------------


@_query
def sensor_files(spark: SparkSession, folder: str) -> DataFrame:
    """The events written as two kinds of sensor files and read back."""
    home = fresh_folder(spark, "sensors")
    time = F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time")
    rows = table(spark, folder, "events")
    rows.select(
        F.col("event_id").alias("packet_id"), time, F.lit(1).alias("tr_id"), F.lit(2).alias("unit_id"),
        F.col("user_id").alias("sensor_id"), F.col("value").alias("val"), F.lit(1).alias("status"),
    ).write.option("header", True).csv(f"{home}/termo")
    rows.select(
        F.col("event_id").alias("packet_id"), time, F.col("user_id").alias("sensor_id"), F.lit(1).alias("tr_id"),
        F.col("value").alias("level_mm"), (F.col("value") / 2).alias("level_l"), F.lit(20.0).alias("temperature"),
        F.lit(True).alias("switched_on"),
    ).write.option("header", True).csv(f"{home}/fuel")
    events = sensors.sensor_events(
        sensors.read_sensor_csv(spark, f"{home}/termo", "termo"), sensors.read_sensor_csv(spark, f"{home}/fuel", "fuel")
    )
    fields = F.from_json("payload", "packet_id BIGINT, val DOUBLE, level_l DOUBLE")
    return events.select(
        "source", "subtype", F.col("ts").cast("timestamp_ntz").alias("ts"), fields["packet_id"].alias("packet_id"),
        F.coalesce(fields["val"], fields["level_l"]).alias("reading"), F.col("tags")["sensor_id"].alias("sensor"),
    )


def _request_time() -> Column:
    return F.when(k_of_props().cast("bigint") % 10 != 0, F.col("ts"))


INGEST_AS_OF = "2024-02-01 00:00:00"
#: Ranges that the JSON file of the events is sorted in.
ARRAY_RANGES = 256


def _blank_some(value: Column, remainder: int) -> Column:
    """Blank text for a part of the rows, so that validation has work to do."""
    return F.when(k_of_props().cast("bigint") % 10 == remainder, F.lit(" \t")).otherwise(value)


def _log_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(F.lit("req-"), F.col("event_id")).alias("id"),
        F.concat(F.lit("svc-"), F.col("user_id") % 2).alias("source"),
        log_level().alias("level"),
        _blank_some(F.col("props"), 3).alias("message"),
        F.lit("ignored").alias("service"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("correlationId"),
        F.create_map(F.lit("k"), k_of_props()).alias("tags"),
        _request_time().alias("timestamp"),
    )


def _metric_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(F.lit("req-"), F.col("event_id")).alias("id"),
        _blank_some(F.concat(F.lit("svc-"), F.col("user_id") % 2), 4).alias("source"),
        F.col("event_type").alias("name"),
        F.when(k_of_props().cast("bigint") % 10 != 5, F.col("value")).alias("value"),
        F.create_map(F.lit("k"), k_of_props()).alias("tags"),
        _request_time().alias("timestamp"),
    )


def _trace_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(F.lit("req-"), F.col("event_id")).alias("id"),
        F.concat(F.lit("trace-"), F.col("user_id")).alias("traceId"),
        F.concat(F.lit("span-"), F.col("event_id")).alias("spanId"),
        F.when(F.col("user_id") % 2 == 0, F.lit("root")).alias("parentSpanId"),
        F.concat(F.lit("svc-"), F.col("user_id") % 2).alias("service"),
        F.col("event_type").alias("operation"),
        F.floor(F.col("value") * 20).alias("durationMs"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("startTime"),
        _request_time().alias("timestamp"),
    )


def _event_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(F.lit("req-"), F.col("event_id")).alias("id"),
        _blank_some(F.concat(F.lit("svc-"), F.col("user_id") % 2), 6).alias("source"),
        _blank_some(F.lit("metric"), 7).alias("type"),
        F.col("event_type").alias("subtype"),
        F.when(F.col("user_id") % 2 == 0, F.col("props")).alias("payload"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("correlationId"),
        F.create_map(F.lit("k"), k_of_props()).alias("tags"),
        _request_time().alias("timestamp"),
    )


def _normalized_view(events: DataFrame, fields: str) -> DataFrame:
    return events.withColumn("fields", F.from_json("payload", fields)).select(
        "id", "source", "type", "subtype", "ts", "correlation_id", "fields.*"
    )


@_query
def normalize_event(spark: SparkSession, folder: str) -> DataFrame:
    made = normalize.ingest(_event_requests(spark, folder), "event", _at(INGEST_AS_OF)).valid
    return made.select("id", "source", "type", "subtype", "ts", "correlation_id", "payload")


@_query
def normalize_log(spark: SparkSession, folder: str) -> DataFrame:
    made = normalize.ingest(_log_requests(spark, folder), "log", _at(INGEST_AS_OF)).valid
    return _normalized_view(made, "level STRING, message STRING")


@_query
def normalize_metric(spark: SparkSession, folder: str) -> DataFrame:
    made = normalize.ingest(_metric_requests(spark, folder), "metric", _at(INGEST_AS_OF)).valid
    return _normalized_view(made, "metric STRING, value DOUBLE")


@_query
def normalize_trace(spark: SparkSession, folder: str) -> DataFrame:
    made = normalize.ingest(_trace_requests(spark, folder), "trace", _at(INGEST_AS_OF)).valid
    return _normalized_view(
        made,
        "traceId STRING, spanId STRING, parentSpanId STRING, operation STRING, "
        "durationMs BIGINT, startTime STRING",
    )


@_query
def validate_split(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected metric and log requests with their reasons."""
    metrics = normalize.ingest(_metric_requests(spark, folder), "metric").rejected
    logs = normalize.ingest(_log_requests(spark, folder), "log").rejected
    columns = ["id", F.array_join("reject_reasons", "; ").alias("reasons")]
    return metrics.select(F.lit("metric").alias("kind"), *columns).unionByName(
        logs.select(F.lit("log").alias("kind"), *columns)
    )


@_query
def batch_receipt(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's events posted as one batch."""
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("batch_id"), F.concat(F.lit("evt-"), F.col("event_id")).alias("id")
    )
    return requests.batch_receipts(events).select("batch_id", "count")


@_query
def split_request_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a JSON array of requests in one file, read by many tasks."""
    home = fresh_folder(spark, "arrays")
    events = table(spark, folder, "events")
    body = json_object(
        source=F.concat(F.lit("svc-"), F.col("user_id") % 2), type=F.col("event_type"), payload=F.col("props"),
        correlationId=F.concat(F.lit("evt-"), F.col("event_id")), tags=F.create_map(F.lit("value"), F.col("value").cast("string")),
    )
    rows = events.select(F.col("event_id"), F.concat(body, F.lit(",")).alias("line"))
    frame = spark.createDataFrame([(-1, "["), (2**62, "{}]")], "event_id long, line string")
    # the one task that writes the file sorts a range at a time
    ranged = rows.unionByName(frame).repartitionByRange(ARRAY_RANGES, "event_id").sortWithinPartitions("event_id")
    ranged.coalesce(1).select("line").write.text(home)
    made = json_arrays.read_large_arrays(spark, home).where("source IS NOT NULL")
    return made.select(
        "source", "type", "payload", F.col("correlationId").alias("correlation_id"), made["tags"]["value"].cast("double").alias("value")
    )


@_query
def batch_receipt_ids(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("batch_id"), F.concat(F.lit("evt-"), F.col("event_id")).alias("id")
    )
    return requests.receipt_ids(events).select("batch_id", "id", "copies")


@_query
def wire_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Events encoded to JSON messages and decoded again."""
    messages = wire.encode_events(telemetry(spark, folder))
    back = wire.decode_events(messages).valid
    metric = F.from_json("payload", "value DOUBLE, durationMs BIGINT, level STRING")
    return back.select(
        metric["value"].alias("value"),
        metric["durationMs"].alias("duration_ms"), metric["level"].alias("level"),
        "id", "source", "type", "subtype", F.col("ts").cast("timestamp_ntz").alias("ts"),
        "correlation_id", F.try_element_at("tags", F.lit("k")).alias("tag_k"),
    )


@_query
def wire_enriched_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched events encoded and decoded again."""
    rows = correlate.enriched_record(correlate.correlate(telemetry(spark, folder), "1 day"))
    messages = wire.encode_enriched(rows)
    back = wire.decode_enriched(messages).valid
    return back.select(
        "original.id", "original.source",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("enrichment_metadata.correlatedCount").alias("correlated_count"),
        F.col("enrichment_metadata.uniqueServices").alias("unique_services"),
    )


@_query
def wire_anomaly_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Anomaly messages, decoded again."""
    messages = wire.encode_anomalies(_rule_anomalies(spark, folder))
    back = wire.decode_anomalies(messages).valid
    return back.select(
        "id", "service", "metric", _round("score"), "severity",
        F.col("detected_at").cast("timestamp_ntz").alias("detected_at"), "correlation_id",
    )


@_query
def wire_insight_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Insight messages, decoded again."""
    messages = wire.encode_insights(insights.annotate(_rule_anomalies(spark, folder)))
    back = wire.decode_insights(messages).valid
    return back.select("id", "anomaly_id", "severity", _round("score"), "incident_classification")


@_query
def wire_message_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The key of every event, anomaly and insight message beside the id it carries."""
    found = _rule_anomalies(spark, folder)
    kinds = {
        "event": wire.encode_events(telemetry(spark, folder)),
        "anomaly": wire.encode_anomalies(found),
        "insight": wire.encode_insights(insights.annotate(found)),
    }
    keyed = [
        messages.select(F.lit(kind).alias("kind"), "key", F.get_json_object("value", "$.id").alias("id"))
        for kind, messages in kinds.items()
    ]
    return keyed[0].unionByName(keyed[1]).unionByName(keyed[2])


@_query
def wire_notices(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and contents of the short alert notices."""
    messages = wire.encode_notices(alerts.broadcast_notices(alert_table(spark, folder)))
    fields = F.from_json("value", "id STRING, severity STRING, source STRING, detectedAt STRING")
    return messages.select("key", fields.alias("f")).select(
        "key", "f.id", "f.severity", "f.source", F.col("f.detectedAt").alias("detected_at")
    )


@_query
def wire_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Messages cut in half, emptied or left whole; counted by what decoding makes of them."""
    k = F.from_json("value", "tags MAP<STRING, STRING>")["tags"]["k"].cast("bigint") % 4
    damaged = (
        F.when(k == 0, F.substring("value", 1, 20)).when(k == 1, F.lit("")).otherwise(F.col("value"))
    )
    messages = wire.encode_events(telemetry(spark, folder)).withColumn("value", damaged)
    made = wire.decode_events(messages)
    outcome = made.valid.select(F.lit("event").alias("outcome")).unionByName(
        made.rejected.select(F.array_join("reject_reasons", "; ").alias("outcome"))
    )
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


# Insights --------------------------------------------------------------------


def _rule_anomalies(spark: SparkSession, folder: str, services: int = ALERT_SERVICES) -> DataFrame:
    return rules.detect_rules(telemetry(spark, folder, services))


@_query
def anomaly_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Severity and time taken from some anomalies and filled in again."""
    found = _rule_anomalies(spark, folder).withColumns(
        {
            "severity": F.when(F.ascii("id") % 2 != 0, F.col("severity")),
            "detected_at": F.when(F.ascii("id") % 3 != 0, F.col("detected_at")),
        }
    )
    filled = normalize.with_anomaly_defaults(found, _at(STATS_AS_OF))
    return filled.select("id", "severity", "detected_at")


@_query
def prompt_text(spark: SparkSession, folder: str) -> DataFrame:
    found = _rule_anomalies(spark, folder)
    # The oracle has its own JSON writer, so the details are left out of the comparison.
    plain = found.withColumn("details", F.lit("none"))
    return plain.select("id", insights.anomaly_prompt("de").alias("prompt"))


@_query
def log_prompt_text(spark: SparkSession, folder: str) -> DataFrame:
    return insights.log_prompts(telemetry(spark, folder), "xx")


def _varied_replies(anomalies: DataFrame) -> DataFrame:
    """Replies of every quality, chosen by the first character of the anomaly id."""
    good = insights.rule_scorer(anomalies)
    turn = F.ascii("id") % 6
    nulls = (
        '{"interpretation":null,"classification":" Spiky ","probableCauses":null,'
        '"recommendations":["look"]}'
    )
    return good.withColumn(
        "reply",
        F.when(turn == 0, nulls)
        .when(turn == 1, '{"interpretation":"half"}')
        .when(turn == 2, "  ")
        .when(turn == 3, "not json")
        .when(turn == 4, F.concat(F.substring("reply", 1, 1), F.lit('"more":1,'), F.expr("substring(reply, 2)")))
        .otherwise(F.col("reply")),
    )


def _insight_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "anomaly_id", "severity", _round("score"), "interpretation",
        "incident_classification",
        F.array_join("probable_causes", "|").alias("causes"),
        F.array_join("recommendations", "|").alias("advice"),
        (F.length("raw_response") > 0).alias("has_raw"),
        F.col("metadata")["service"].alias("service"), F.col("metadata")["metric"].alias("metric"),
    )


@_query
def insight_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _insight_view(insights.annotate(_rule_anomalies(spark, folder)))


@_query
def insight_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return _insight_view(insights.annotate(_rule_anomalies(spark, folder), _varied_replies))


def _moody_model(prompts: pd.Series) -> pd.Series:
    """Fails for any batch that asks about a critical anomaly."""
    if prompts.str.contains("CRITICAL").any():
        raise RuntimeError("no answer")
    reply = {"interpretation": "fine", "classification": "Other", "probableCauses": [], "recommendations": []}
    return prompts.map(lambda _: json.dumps(reply))


@_query
def insight_scorer_failures(spark: SparkSession, folder: str) -> DataFrame:
    """A scorer that fails for critical anomalies leaves the insights of all others alone."""
    made = insights.annotate(_rule_anomalies(spark, folder), insights.batch_scorer(_moody_model))
    return made.select("anomaly_id", "interpretation", "incident_classification")


# Alerts ----------------------------------------------------------------------


def alert_table(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of all rule anomalies; status from the alert id, resolved an hour later."""
    made = alerts.create_alerts(insights.annotate(_rule_anomalies(spark, folder)))
    turn = F.ascii("id") % 3
    status = F.when(turn == 0, "OPEN").when(turn == 1, "ACK").otherwise("RESOLVED")
    return made.withColumn("status", status).withColumn(
        "resolved_at",
        F.when(status == "RESOLVED", F.col("detected_at") + F.expr("INTERVAL 1 HOUR")),
    )


@_query
def alerts_from_insights(spark: SparkSession, folder: str) -> DataFrame:
    """Insights delivered twice against a store that holds the critical ones already."""
    once = insights.annotate(_rule_anomalies(spark, folder))
    again = once.withColumn("analyzed_at", F.col("analyzed_at") + F.expr("INTERVAL 1 MINUTE"))
    stored = alerts.create_alerts(once.where(F.col("severity") == "CRITICAL"))
    fresh = alerts.create_alerts(once.unionByName(again), stored)
    return fresh.select(
        "id", "title", "severity", "status", "source", "description", "recommendation",
        "anomaly_id", "detected_at",
    )


@_query
def alerts_from_all_detectors(spark: SparkSession, folder: str) -> DataFrame:
    """Anomalies of all three detectors through insights to alerts."""
    events = telemetry(spark, folder)
    found = detect.union_anomalies(
        detect.detect_raw(events, "1 day"), detect.detect_enriched(events, "1 day"), rules.detect_rules(events)
    )
    made = alerts.create_alerts(insights.annotate(found))
    return made.select("id", "severity", "status", "source", "anomaly_id", "detected_at")


@_query
def alert_notifications(spark: SparkSession, folder: str) -> DataFrame:
    sent = alerts.notifications(alert_table(spark, folder))
    return sent.select("type", "id", "title", "severity", "status", "source",
                       F.col("detectedAt").alias("detected_at"))


def _listed(rows: DataFrame) -> DataFrame:
    return rows.select("id", "severity", "status", "source", "detected_at")


@_query
def alert_list_status(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(alerts.list_alerts(alert_table(spark, folder), status="OPEN",
                                      severity="CRITICAL", limit=1))


@_query
def alert_list_severity(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(alerts.list_alerts(alert_table(spark, folder), status=" ", severity="CRITICAL"))


@_query
def alert_list_range(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(alerts.list_alerts(
        alert_table(spark, folder), since="2024-01-05T00:00:00Z", until="2024-01-06T00:00:00Z",
        limit=200,
    ))


@_query
def alert_list_since(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(alerts.list_alerts(alert_table(spark, folder), since="2024-01-20T00:00:00Z"))


@_query
def alert_list_all(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(alerts.list_alerts(alert_table(spark, folder), until="2024-01-02T00:00:00Z"))


@_query
def alert_list_hour(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(alerts.alerts_of_hour(alert_table(spark, folder), "2024-01-10 10:00:00"))


def _status_requests(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two requests per alert, and with the first ones a request for an alert nobody has."""
    turn = F.ascii(F.substring("id", 2, 1)) % 4
    wanted = F.when(turn == 0, "ACK").when(turn == 1, "RESOLVED").when(turn == 2, "OPEN").otherwise("ACK")
    first = rows.select(
        F.col("id").alias("alert_id"), wanted.alias("new_status"),
        (F.col("detected_at") + F.expr("INTERVAL 1 HOUR")).alias("at"),
    )
    second = rows.select(
        F.col("id").alias("alert_id"),
        F.when(turn == 3, "ACK").otherwise("RESOLVED").alias("new_status"),
        (F.col("detected_at") + F.expr("INTERVAL 2 HOURS")).alias("at"),
    )
    unknown = rows.select(
        F.concat(F.lit("x"), F.col("id")).alias("alert_id"), F.lit("ACK").alias("new_status"),
        F.col("detected_at").alias("at"),
    )
    return first.unionByName(unknown), second


def _status_updates(rows: DataFrame) -> DataFrame:
    first, second = _status_requests(rows)
    return first.unionByName(second)


@_query
def alert_status_updates(spark: SparkSession, folder: str) -> DataFrame:
    rows = alert_table(spark, folder)
    result = alerts.apply_status_updates(rows, _status_updates(rows))
    return result.alerts.select("id", "status", "resolved_at")


@_query
def alert_status_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    rows = alert_table(spark, folder)
    result = alerts.apply_status_updates(rows, _status_updates(rows))
    return result.outcomes.select("alert_id", "new_status", "at", "old_status", "outcome", "copies")


@_query
def alerts_open_by_severity(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.open_by_severity(alert_table(spark, folder))


@_query
def alerts_by_severity(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.by_severity(alert_table(spark, folder))


@_query
def alerts_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.by_status(alert_table(spark, folder))


@_query
def alerts_by_source_top10(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.top_sources(alert_table(spark, folder))


@_query
def alerts_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.hourly(alert_table(spark, folder), _at(STATS_AS_OF))


@_query
def alerts_totals(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.totals(alert_table(spark, folder), _at(STATS_AS_OF))


@_query
def alerts_summary(spark: SparkSession, folder: str) -> DataFrame:
    row = alert_stats.alert_summary(alert_table(spark, folder))
    return row.withColumn(
        "open_by_severity",
        F.array_join(F.transform("open_by_severity",
                                 lambda s: F.concat_ws("=", s["severity"], s["count"])), ","),
    )


@_query
def alerts_statistics(spark: SparkSession, folder: str) -> DataFrame:
    row = alert_stats.alert_statistics_row(alert_table(spark, folder), _at(STATS_AS_OF))

    def text(column: str, label: str) -> Column:
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws("=", s[label].cast("string"), s["count"])), ","
        ).alias(column)

    return row.select(
        "total", "critical", "warning", "last_hour", "last_day",
        text("by_source", "source"), text("by_severity", "severity"),
        text("by_status", "status"), text("hourly", "hour"),
    )


@_query
def category_share(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.shares(alert_stats.by_severity(alert_table(spark, folder)))


@_query
def hourly_bars(spark: SparkSession, folder: str) -> DataFrame:
    return alert_stats.hourly_bars(alert_table(spark, folder), _at(STATS_AS_OF))


@_query
def dashboard_summary(spark: SparkSession, folder: str) -> DataFrame:
    row = alert_stats.dashboard_summary(alert_table(spark, folder), storage_summary(spark, folder))
    return row.drop("open_by_severity")


# Streams ---------------------------------------------------------------------


@_query
def stream_raw_zscore(spark: SparkSession, folder: str) -> DataFrame:
    events = telemetry_of(events_stream(spark, folder))
    found = streams.run_to_table(streams.raw_zscore_stream(events, "1 day"), "raw-zscore")
    return _anomaly_view(found)


@_query
def stream_enriched_zscore(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched hits of a stream with the counts of the events and services behind them."""
    home = fresh_folder(spark, "enriched")
    events = telemetry_of(events_stream(spark, folder))
    query = windows.enriched_context_stream(
        events, home, f"{home}/checkpoint", bucket="1 day", available_now=True
    )
    query.awaitTermination()
    return _context_view(windows.window_rows(spark, home))


@_query
def stream_correlate(spark: SparkSession, folder: str) -> DataFrame:
    events = telemetry_of(events_stream(spark, folder))
    rows = streams.run_to_table(streams.correlate_stream(events, "1 day"), "correlate")
    return _correlate_view(rows)


@_query
def stream_alert_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The same insights delivered twice to the alert stream."""
    events = telemetry_of(events_stream(spark, folder), ALERT_SERVICES)
    flow = insights.annotate(rules.detect_rules(events))
    home = fresh_folder(spark, "alerts")
    query = streams.alert_stream(
        flow.unionByName(flow), f"{home}/rows", f"{home}/checkpoint", available_now=True
    )
    query.awaitTermination()
    rows = streams.stored_alerts(spark, f"{home}/rows")
    return rows.select(
        "id", "title", "severity", "source",
        F.col("detected_at").cast("timestamp_ntz").alias("detected_at"),
    )


@_query
def stream_alert_status(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts and their requests as streams; the second requests come with a later micro-batch, of a query begun again."""
    home = fresh_folder(spark, "status")
    at = F.col("at").cast("timestamp")
    rows = alert_table(spark, folder).withColumn("detected_at", F.col("detected_at").cast("timestamp"))
    rows.write.parquet(f"{home}/alerts")
    stored = spark.read.parquet(f"{home}/alerts")

    def stream(name: str) -> DataFrame:
        path = f"{home}/{name}"
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    for requests_of_turn in _status_requests(stored):
        requests_of_turn.withColumn("at", at).write.mode("append").parquet(f"{home}/requests")
        query = status.status_state_stream(
            stream("alerts"), stream("requests"), f"{home}/judged", f"{home}/checkpoint", available_now=True
        )
        query.awaitTermination()
    judged = spark.read.parquet(f"{home}/judged")
    return judged.select(
        "alert_id", "new_status", F.col("at").cast("timestamp_ntz").alias("at"), "old_status", "outcome", "copies"
    )

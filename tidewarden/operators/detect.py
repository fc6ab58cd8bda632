"""Z-score detectors over tumbling windows.

Plan: one narrow scan aggregates count, mean, population deviation and extremes
per (window, source, metric) with map-side combining. The extremes tell which
groups hold a hit at all, so the join back to the samples carries only those
groups. Nothing is collected per group and no task receives a whole hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.buckets import window_bounds
from ..functions.exact_sums import exact_sums
from ..functions.skew import join_groups
from ..functions.text import json_object, never_null, stable_id, without_id
from ..schemas import CRITICAL, METRIC, WARNING
from ..session import written_once
from .correlate import attach_context, correlated

# Detector thresholds.
MIN_SAMPLES = 5
Z_THRESHOLD = 3.0
Z_CRITICAL = 5.0
MIN_STDDEV = 0.001
DEFAULT_WINDOW = "1 minute"
#: How much a statistic may change with the order of summation, far more than it does.
SLACK = 1e-6

GROUP = ["window_start", "window_end", "source", "metric"]

ANOMALY_COLUMNS = [
    "id", "service", "metric", "score", "severity", "description", "detected_at",
    "details", "correlation_id", "detector", "event_id",
]


def metric_samples(events: DataFrame) -> DataFrame:
    """Metric events as narrow rows: who, which metric, and the value if it is a JSON number."""
    parsed = P.with_fields(events.where(F.col("type") == METRIC), P.METRIC_FIELDS)
    return parsed.select(
        F.col("id").alias("event_id"),
        never_null(F.col("source"), F.lit("")).alias("source"),
        P.metric_name(F.col("payload"), F.col("fields"), F.col("subtype")).alias("metric"),
        F.col("fields.value").alias("value"),
        "ts",
        "correlation_id",
    )


def windowed_samples(events: DataFrame, bucket: str) -> DataFrame:
    return metric_samples(events).select(
        *window_bounds("ts", bucket, events.schema["ts"].dataType), "*"
    )


def window_stats(samples: DataFrame) -> DataFrame:
    """Group statistics; ``events`` counts every event, the rest only numeric ones."""
    return samples.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("events"),
        F.count("value").alias("samples"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("stddev"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def z_score(value: Column) -> Column:
    return F.abs(F.try_divide(value - F.col("mean"), F.col("stddev")))


def exceeds(z: Column, limit: float) -> Column:
    """NaN, which Spark orders above every number, exceeds nothing."""
    return ~F.isnan(z) & (z > F.lit(limit))


def enough_data(min_samples: int, min_stddev: float) -> Column:
    return (
        (F.col("events") >= min_samples)
        & (F.col("samples") >= min_samples)
        & (F.col("stddev") >= F.lit(min_stddev))
    )


def can_fire(threshold: float, min_samples: int, min_stddev: float) -> Column:
    """Exact group test: the largest deviation is always at the minimum or the maximum."""
    return enough_data(min_samples, min_stddev) & (
        exceeds(z_score(F.col("low")), threshold) | exceeds(z_score(F.col("high")), threshold)
    )


def firing_groups(
    samples: DataFrame,
    threshold: float = Z_THRESHOLD,
    min_samples: int = MIN_SAMPLES,
    min_stddev: float = MIN_STDDEV,
) -> DataFrame:
    """Keys of the groups that hold at least one hit, from their statistics alone."""
    return window_stats(samples).where(can_fire(threshold, min_samples, min_stddev)).select(*GROUP)


def firing_rows(
    samples: DataFrame,
    threshold: float = Z_THRESHOLD,
    min_samples: int = MIN_SAMPLES,
    min_stddev: float = MIN_STDDEV,
) -> DataFrame:
    """All samples, numeric or not, of the groups that hold a hit, with the statistics of their group."""
    firing = can_fire(threshold, min_samples, min_stddev)
    return join_groups(samples, window_stats(samples), GROUP, "events", ["event_id", "ts"], keep=firing)


def _thresholds(options: dict) -> dict:
    found = {k: v for k, v in options.items() if k in ("threshold", "min_samples", "min_stddev")}
    if options.get("strategy") == "exact":  # a superset: what lies at a threshold is decided later
        found["threshold"] = found.get("threshold", Z_THRESHOLD) * (1 - SLACK)
        found["min_stddev"] = found.get("min_stddev", MIN_STDDEV) * (1 - SLACK)
    return found


def describe(z: Column) -> Column:
    return F.format_string(
        "Z-score %.2f for %s (value=%.1f, mean=%.1f, stddev=%.1f)",
        z, F.col("metric"), F.col("value"), F.col("mean"), F.col("stddev"),
    )


def hits_of(scored: DataFrame, detector: str, threshold: float, critical: float) -> DataFrame:
    """Rows that carry their group statistics to anomaly rows."""
    z = z_score(F.col("value"))
    return scored.where(exceeds(z, threshold)).select(
        stable_id(F.lit(detector), F.col("window_start"), F.col("source"), F.col("metric"),
                  F.col("event_id"), without_id(F.col("event_id"), "ts", "value")).alias("id"),
        F.col("source").alias("service"),
        "metric",
        z.alias("score"),
        F.when(z > F.lit(critical), CRITICAL).otherwise(WARNING).alias("severity"),
        describe(z).alias("description"),
        F.col("window_end").alias("detected_at"),
        json_object(
            value=F.col("value"), mean=F.col("mean"), stddev=F.col("stddev"),
            zScore=z, windowSize=F.col("events"),
        ).alias("details"),
        "correlation_id",
        F.lit(detector).alias("detector"),
        "event_id",
        "window_start",
        "window_end",
        "value", "mean", "stddev", "events",
    )


def exact_hits(
    samples: DataFrame,
    detector: str,
    threshold: float = Z_THRESHOLD,
    critical: float = Z_CRITICAL,
    min_samples: int = MIN_SAMPLES,
    min_stddev: float = MIN_STDDEV,
) -> DataFrame:
    """:func:`zscore_hits` with statistics that are the same, bit by bit, for every partitioning.

    The usual statistics, with some slack, tell which groups may hold a hit. Only the samples of those are
    written and gone through twice more: once for the mean, from an exact sum, and
    once for the deviation from that mean. Where no hit lies at a threshold both forms agree.
    """
    stats = window_stats(samples)
    likely = can_fire(threshold * (1 - SLACK), min_samples, min_stddev * (1 - SLACK))
    numeric = samples.where(F.col("value").isNotNull())
    some = join_groups(numeric, stats.select(*GROUP, "events", "samples", "stddev", "mean", "low", "high"), GROUP, "events", ["event_id", "ts"], keep=likely)
    rows = written_once(some.drop("stddev", "mean"), "likely-groups")
    sizes = rows.groupBy(*GROUP).agg(F.max("events").alias("_n"), F.max("samples").alias("samples"))

    def attached(rows: DataFrame, sums: DataFrame, name: str, made: Column) -> DataFrame:
        groups = sizes.join(sums, GROUP).select(*GROUP, "_n", made.alias(name))
        return join_groups(rows, groups, GROUP, "_n", ["event_id", "ts"]).drop("_n")

    centred = attached(rows, exact_sums(rows, GROUP, "value", "_sum"), "mean", F.col("_sum") / F.col("samples"))
    squares = centred.withColumn("_square", (F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean")))
    spread = exact_sums(squares, GROUP, "_square", "_sum")
    scored = attached(centred, spread, "stddev", F.sqrt(F.col("_sum") / F.col("samples")))
    fires = can_fire(threshold, min_samples, min_stddev)
    return hits_of(scored.where(fires), detector, threshold, critical)


def zscore_hits(
    samples: DataFrame,
    detector: str,
    threshold: float = Z_THRESHOLD,
    critical: float = Z_CRITICAL,
    min_samples: int = MIN_SAMPLES,
    min_stddev: float = MIN_STDDEV,
    strategy: str = "salted",
) -> DataFrame:
    """Samples whose absolute z-score is strictly above the threshold.

    ``salted`` spreads the rows of hot groups itself; ``adaptive`` leaves the
    join back to AQE (run-time broadcast or skew split); ``exact`` is :func:`exact_hits`.
    """
    if strategy == "exact":
        return exact_hits(samples, detector, threshold, critical, min_samples, min_stddev)
    stats = window_stats(samples)
    firing = can_fire(threshold, min_samples, min_stddev)
    numeric = samples.where(F.col("value").isNotNull())
    if strategy == "salted":
        scored = join_groups(numeric, stats, GROUP, "events", ["event_id", "ts"], keep=firing)
    elif strategy == "adaptive":
        scored = numeric.join(stats.where(firing), GROUP)
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    return hits_of(scored, detector, threshold, critical)


def detect_raw(events: DataFrame, bucket: str = DEFAULT_WINDOW, **options) -> DataFrame:
    """Z-score anomalies on all metric events, correlated or not."""
    hits = zscore_hits(windowed_samples(events, bucket), "raw-zscore", **options)
    return hits.select(*ANOMALY_COLUMNS)


def detect_enriched(
    events: DataFrame,
    bucket: str = DEFAULT_WINDOW,
    context: bool = True,
    **options,
) -> DataFrame:
    """Z-score anomalies on metric events that belong to a correlation group.

    ``context`` adds to the details how many events and services the metric's
    correlation groups hold, exact for groups of any size; ``correlate.context_links``
    leads to them as rows.
    """
    samples = windowed_samples(correlated(events), bucket)
    if not context:
        return zscore_hits(samples, "enriched-zscore", **options).select(*ANOMALY_COLUMNS)
    # few rows, needed for the hits and for what they hang together with
    firing = written_once(firing_rows(samples, **_thresholds(options)), "firing-rows")
    if options.get("strategy") == "exact":
        hits = zscore_hits(samples, "enriched-zscore", **options)
    else:
        limits = options.get("threshold", Z_THRESHOLD), options.get("critical", Z_CRITICAL)
        hits = hits_of(firing.where(F.col("value").isNotNull()), "enriched-zscore", *limits)
    links = firing.select(*GROUP, "correlation_id").distinct()
    return attach_context(hits, links, correlated(events), bucket).select(*ANOMALY_COLUMNS)


def union_anomalies(*frames: DataFrame) -> DataFrame:
    """Bag union; one correlated spike may appear once per detector."""
    first, *others = [f.select(*ANOMALY_COLUMNS) for f in frames]
    for frame in others:
        first = first.unionByName(frame)
    return first

"""Metric points and their time-bucketed rollup."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.buckets import bucket_start, within
from ..functions.text import never_null
from ..schemas import DEFAULT_BUCKET, DEFAULT_LIMIT, METRIC
from .percentiles import (
    INLINE_VALUES,
    distinct_values,
    exact_percentiles,
    value_counts,
)

PERCENTILES = [0.95, 0.99]
KEYS = ["bucket", "service", "metric_name"]


class MetricPoints(NamedTuple):
    points: DataFrame
    rejected: DataFrame


def metric_points(events: DataFrame) -> MetricPoints:
    """Metric events as stored points; a point without any name is rejected."""
    parsed = P.with_fields(events.where(F.col("type") == METRIC), P.METRIC_FIELDS)
    points = parsed.select(
        F.col("ts").alias("time"),
        F.concat(F.col("id"), F.lit("-m")).alias("id"),
        F.col("source").alias("service"),
        P.stored_metric_name(F.col("fields"), F.col("subtype")).alias("metric_name"),
        P.stored_value(F.col("fields")).alias("value"),
        "tags",
    )
    named = F.col("metric_name").isNotNull()
    reasons = F.array(F.lit("metric name is missing"))
    return MetricPoints(
        points.where(named), points.where(~named).withColumn("reject_reasons", reasons)
    )


def _given(text: str | None) -> bool:
    return text is not None and text.strip() != ""


def effective_limit(limit: int | None) -> int:
    return limit if limit is not None and limit > 0 else DEFAULT_LIMIT


def select_points(
    points: DataFrame,
    service: str | None = None,
    metric_name: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Optional equality filters (blank means none) and an inclusive time range."""
    points = within(points, "time", start, end)
    if _given(service):
        points = points.where(F.col("service") == service)
    if _given(metric_name):
        points = points.where(F.col("metric_name") == metric_name)
    return points


def metric_rollup(
    points: DataFrame,
    bucket: str | None = DEFAULT_BUCKET,
    percentiles: str = "exact",
    inline_values: int = INLINE_VALUES,
) -> DataFrame:
    """Average, extremes, p95, p99 and count per (bucket, service, metric).

    ``percentiles="approximate"`` answers in a single pass with Spark's sketch.
    """
    kind = points.schema["time"].dataType
    epoch = F.lit("1970-01-01 00:00:00").cast(kind)
    keyed = points.where(F.col("time").isNotNull()).select(
        never_null(bucket_start(F.col("time"), bucket).cast(kind), epoch).alias("bucket"),
        never_null(F.col("service"), F.lit("")).alias("service"),
        never_null(F.col("metric_name"), F.lit("")).alias("metric_name"),
        "value",
    )
    if percentiles == "approximate":
        sketch = F.percentile_approx(
            "value", F.array(*[F.lit(p) for p in PERCENTILES]), F.lit(10_000)
        )
        wide = keyed.groupBy(*KEYS).agg(
            F.avg("value").alias("avg"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.count(F.lit(1)).alias("cnt"),
            sketch.alias("percentiles"),
        )
    elif percentiles == "exact":
        values = distinct_values(keyed, KEYS, "value")
        groups = values.groupBy(*KEYS).agg(
            F.sum(F.col("value") * F.col("n")).alias("sum"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.sum("n").alias("cnt"),
            *value_counts(),
        ).withColumn("avg", F.try_divide("sum", "n"))
        exact = exact_percentiles(values, groups, KEYS, PERCENTILES, inline_values=inline_values)
        wide = groups.join(exact, KEYS, "left")
    else:
        raise ValueError(f"unknown percentile mode: {percentiles}")
    return wide.select(
        *KEYS, "avg", "min", "max",
        F.get("percentiles", 0).alias("p95"), F.get("percentiles", 1).alias("p99"), "cnt",
    )


def latest_rollup(
    points: DataFrame,
    bucket: str | None = DEFAULT_BUCKET,
    limit: int | None = None,
    service: str | None = None,
    metric_name: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
    **options,
) -> DataFrame:
    """The metric query: filtered rollup, newest buckets first, limited."""
    chosen = select_points(points, service, metric_name, start, end)
    return (
        metric_rollup(chosen, bucket, **options)
        .orderBy(F.desc("bucket"), "service", "metric_name")
        .limit(effective_limit(limit))
    )

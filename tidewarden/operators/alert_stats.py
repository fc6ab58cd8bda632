"""Counts over the alert table. Every "now" is the parameter ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACK, CRITICAL, OPEN, RESOLVED, WARNING

TOP_SOURCES = 10


def _counted(alerts: DataFrame, name: str) -> DataFrame:
    return alerts.groupBy(name).agg(F.count(F.lit(1)).alias("count"))


def status_counts(alerts: DataFrame) -> DataFrame:
    """One row with the number of open, acknowledged and resolved alerts."""
    return alerts.agg(
        F.count_if(F.col("status") == OPEN).alias("open_count"),
        F.count_if(F.col("status") == ACK).alias("acknowledged_count"),
        F.count_if(F.col("status") == RESOLVED).alias("resolved_count"),
    )


def open_by_severity(alerts: DataFrame) -> DataFrame:
    return _counted(alerts.where(F.col("status") == OPEN), "severity")


def by_severity(alerts: DataFrame) -> DataFrame:
    return _counted(alerts, "severity")


def by_status(alerts: DataFrame) -> DataFrame:
    return _counted(alerts, "status")


def top_sources(alerts: DataFrame, limit: int = TOP_SOURCES) -> DataFrame:
    """Most frequent sources; ties in source order."""
    return _counted(alerts, "source").orderBy(F.desc("count"), "source").limit(limit)


def hourly(alerts: DataFrame, as_of: Column) -> DataFrame:
    """Alerts per hour over the day before ``as_of``; hours without alerts are absent."""
    kind = alerts.schema["detected_at"].dataType
    since = as_of - F.expr("INTERVAL 1 DAY")
    return (
        alerts.where(F.col("detected_at") >= since)
        .groupBy(F.date_trunc("hour", "detected_at").cast(kind).alias("hour"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("hour")
    )


def _total_counts(as_of: Column) -> list[Column]:
    at = F.col("detected_at")
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("severity") == CRITICAL).alias("critical"),
        F.count_if(F.col("severity") == WARNING).alias("warning"),
        F.count_if(at > as_of - F.expr("INTERVAL 1 HOUR")).alias("last_hour"),
        F.count_if(at > as_of - F.expr("INTERVAL 1 DAY")).alias("last_day"),
    ]


def totals(alerts: DataFrame, as_of: Column) -> DataFrame:
    """One row: all, critical, warning, and those strictly after an hour and a day ago."""
    return alerts.agg(*_total_counts(as_of))


def _nested(rollup: DataFrame) -> Column:
    """A short rollup as one array value."""
    return rollup.agg(F.array_sort(F.collect_list(F.struct(*rollup.columns)))).scalar()


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Status counts with the open alerts per severity as an array of structs."""
    return status_counts(alerts).withColumn("open_by_severity", _nested(open_by_severity(alerts)))


def alert_statistics(alerts: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """All statistics as separate frames."""
    return {
        "totals": totals(alerts, as_of),
        "by_source": top_sources(alerts),
        "by_severity": by_severity(alerts),
        "by_status": by_status(alerts),
        "hourly": hourly(alerts, as_of),
    }


def alert_statistics_row(alerts: DataFrame, as_of: Column) -> DataFrame:
    """The same statistics in one row; the lists are short by nature.

    Grouping sets answer everything but the sources in one pass; the sources, of
    which there may be many, take a second pass that ends in a top-k.
    """
    kind = alerts.schema["detected_at"].dataType
    recent = F.col("detected_at") >= as_of - F.expr("INTERVAL 1 DAY")
    rows = alerts.select(
        "severity", "status", "detected_at",
        F.col("severity").alias("by_severity"),
        F.col("status").alias("by_status"),
        F.when(recent, F.date_trunc("hour", "detected_at").cast(kind)).alias("by_hour"),
    )
    sets = ["by_severity", "by_status", "by_hour"]
    counted = rows.groupingSets([[name] for name in sets] + [[]], *sets).agg(
        *_total_counts(as_of), *[F.grouping(name).alias(f"not_{name}") for name in sets]
    )

    def listed(name: str, label: str) -> Column:
        item = F.struct(F.col(name).alias(label), F.col("total").alias("count"))
        applies = (F.col(f"not_{name}") == 0) & F.col(name).isNotNull()
        return F.array_sort(F.collect_list(F.when(applies, item)))

    overall = F.col("not_by_severity") + F.col("not_by_status") + F.col("not_by_hour") == 3
    names = ["total", "critical", "warning", "last_hour", "last_day"]
    row = counted.agg(
        F.max(F.when(overall, F.struct(*names))).alias("overall"),
        listed("by_severity", "severity").alias("by_severity"),
        listed("by_status", "status").alias("by_status"),
        listed("by_hour", "hour").alias("hourly"),
    )
    ranked = F.struct((-F.col("count")).alias("rank"), "source", "count")
    top = top_sources(alerts).agg(F.array_sort(F.collect_list(ranked))).scalar()
    named = F.transform(
        "top", lambda s: F.struct(s["source"].alias("source"), s["count"].alias("count"))
    )
    return row.withColumn("top", top).select(
        *[F.coalesce(F.col(f"overall.{name}"), F.lit(0)).alias(name) for name in names],
        named.alias("by_source"), "by_severity", "by_status", "hourly",
    )


def shares(rollup: DataFrame, scale: int = 100) -> DataFrame:
    """Bar width of each category against the largest one, at least one counting as largest."""
    largest = rollup.agg(F.greatest(F.max("count"), F.lit(1))).scalar()
    return rollup.withColumn(
        "share", F.floor(F.lit(scale) * F.col("count") / largest + 0.5).cast("bigint")
    )


def hourly_bars(alerts: DataFrame, as_of: Column) -> DataFrame:
    """Hourly counts with bar heights out of 72."""
    return shares(hourly(alerts, as_of), scale=72)


def dashboard_summary(alerts: DataFrame, storage: DataFrame) -> DataFrame:
    """Alert summary beside the one-row storage summary."""
    kept = storage.select(F.struct(*storage.columns)).scalar()
    wide = alert_summary(alerts).withColumn("storage", kept)
    return wide.select("*", "storage.*").drop("storage")

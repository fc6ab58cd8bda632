"""Telemetry views over the supplied tables.

``events`` plays the part of a telemetry feed: every row becomes one event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import json_object


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def k_of_props() -> Column:
    return F.get_json_object("props", "$.k")


def log_level() -> Column:
    k = k_of_props().cast("bigint") % 3
    return F.when(k == 0, "ERROR").when(k == 1, "FATAL").otherwise("WARN")


def telemetry_of(events: DataFrame, services: int = 2) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "error", "log")
        .when(F.col("event_type") == "purchase", "trace")
        .otherwise("metric")
    )
    payload = (
        F.when(kind == "metric", json_object(metric=F.col("event_type"), value=F.col("value")))
        .when(kind == "log", json_object(level=log_level(), message=F.col("props")))
        .otherwise(
            json_object(
                operation=F.col("event_type"),
                durationMs=F.floor(F.col("value") * 20),
            )
        )
    )
    return events.select(
        F.concat(F.lit("evt-"), F.col("event_id")).alias("id"),
        F.concat(F.lit("svc-"), F.col("user_id") % services).alias("source"),
        kind.alias("type"),
        F.col("event_type").alias("subtype"),
        payload.alias("payload"),
        "ts",
        F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("user-"), F.col("user_id"))).alias(
            "correlation_id"
        ),
        F.create_map(F.lit("k"), k_of_props()).alias("tags"),
    )


def telemetry(spark: SparkSession, folder: str, services: int = 2) -> DataFrame:
    return telemetry_of(table(spark, folder, "events"), services)

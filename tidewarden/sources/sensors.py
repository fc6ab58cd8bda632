"""Sensor CSV files as telemetry events.

The payload keeps the sensor's own field names, so it holds no ``value``: the
z-score detectors do not see these events and a stored point gets 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import json_object, stable_id
from ..schemas import FUEL_CSV, METRIC, TERMO_CSV


def read_sensor_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = {"termo": TERMO_CSV, "fuel": FUEL_CSV}[kind]
    return spark.read.schema(schema).option("header", True).csv(path)


def _events(rows: DataFrame, source: str, subtype: str, fields: list[str], tags: list[str]) -> DataFrame:
    pairs = [part for t in tags for part in (F.lit(t), F.col(t).cast("string"))]
    identity = stable_id(
        F.lit(source), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]
    )
    return rows.select(
        identity.alias("id"),
        F.lit(source).alias("source"),
        F.lit(METRIC).alias("type"),
        F.lit(subtype).alias("subtype"),
        json_object(**{f: F.col(f) for f in fields}).alias("payload"),
        F.col("event_time").alias("ts"),
        F.lit(None).cast("string").alias("correlation_id"),
        F.create_map(*pairs).alias("tags"),
    )


def termo_events(rows: DataFrame) -> DataFrame:
    return _events(
        rows, "termo-sensor", "temperature",
        ["packet_id", "val", "status"], ["tr_id", "unit_id", "sensor_id"],
    )


def fuel_events(rows: DataFrame) -> DataFrame:
    return _events(
        rows, "fuel-sensor", "fuel-level",
        ["packet_id", "level_mm", "level_l", "temperature", "switched_on"], ["tr_id", "sensor_id"],
    )


def sensor_events(termo: DataFrame, fuel: DataFrame) -> DataFrame:
    return termo_events(termo).unionByName(fuel_events(fuel))

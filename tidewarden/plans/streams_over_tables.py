"""The events table as a stream that ends, for the streaming queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_folder
from .views import table


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of ``events``, followed in the same input by one far-future row per stream.

    The extra row moves the watermark past the last window. Its own window stays
    open and is never emitted.
    """
    schema = table(spark, folder, "events").schema
    flush_folder = fresh_folder(spark, "flush")
    flush = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"),
        F.lit("2100-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(0.0).alias("value"),
        F.lit('{"k": 0}').alias("props"),
    )
    flush.coalesce(1).write.parquet(flush_folder)
    reader = spark.readStream.schema(schema)
    rows = reader.parquet(f"{folder}/event[s].parquet").unionByName(reader.parquet(flush_folder))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))

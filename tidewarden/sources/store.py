"""Parquet store: events and metric points, partitioned by day and writing batch.

Writers append. A batch writes only the partitions that carry its own number, so
writing it again replaces its own files and nothing else. Readers see the latest
row per key. :mod:`.compaction` rewrites the many small batches of a day; readers
then take the rewritten day and the batches after it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import has_text
from ..operators.normalize import split_valid
from ..operators.rollup import metric_points
from ..schemas import METRIC_POINT, TELEMETRY_EVENT
from . import compaction

EVENT_ROWS = T.StructType([*TELEMETRY_EVENT.fields, T.StructField("received_at", T.TimestampType())])


class StoredBatch(NamedTuple):
    events: DataFrame
    points: DataFrame
    rejected: DataFrame


def stored_batch(events: DataFrame, received_at: Column) -> StoredBatch:
    """Event rows and metric point rows of one batch, and the rows neither table takes."""
    judged = split_valid(
        events,
        {"id is blank": has_text("id"), "time is missing": F.col("ts").isNotNull()},
    )
    made = metric_points(judged.valid)
    rejected = judged.rejected.select("id", "reject_reasons").unionByName(
        made.rejected.select("id", "reject_reasons")
    )
    return StoredBatch(judged.valid.withColumn("received_at", received_at), made.points, rejected)


def append(rows: DataFrame, path: str, time: str | None, order: list[str], batch: int) -> None:
    """Write one batch. The rebalance hint lets AQE size files and split a hot day.

    Without a ``time`` the table is partitioned by batch alone.
    """
    rows = rows.withColumn("batch", F.lit(batch).cast("bigint"))
    days = ["event_date"] if time else []
    if time:
        rows = rows.withColumn("event_date", F.to_date(time)).hint("rebalance", "event_date")
    (
        rows.sortWithinPartitions(*days, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*days, "batch")
        .parquet(path)
    )


def write_batch(events: DataFrame, root: str, batch: int, received_at: Column | None = None) -> None:
    """Store the events and the metric points derived from them."""
    received = F.current_timestamp() if received_at is None else received_at
    kept = events.persist()  # three tables are written from one reading of the batch
    try:
        made = stored_batch(kept, received)
        append(made.events, f"{root}/events", "ts", ["source", "type", "ts"], batch)
        append(made.points, f"{root}/points", "time", ["service", "metric_name", "time"], batch)
        # by batch only: a retry on another day must find the folder of the first attempt
        append(made.rejected.withColumn("seen", received), f"{root}/rejected", None, ["id"], batch)
    finally:
        kept.unpersist()


def _day_range(rows: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    """Partition bounds from a time range; Spark does not derive them by itself."""
    if start is not None:
        rows = rows.where(F.col("event_date") >= F.to_date(start))
    if end is not None:
        rows = rows.where(F.col("event_date") <= F.to_date(end))
    return rows


def read_events(
    spark: SparkSession, root: str, start: Column | None = None, end: Column | None = None,
    every_copy: bool = False,
) -> DataFrame:
    """Stored events of the days in a range, the latest row per id; ``every_copy`` skips that."""
    rows = _day_range(compaction.stored_rows(spark, f"{root}/events", EVENT_ROWS), start, end)
    return rows if every_copy else current_events(rows)


def read_points(
    spark: SparkSession, root: str, start: Column | None = None, end: Column | None = None,
    every_copy: bool = False,
) -> DataFrame:
    """Stored points of the days in a range, the latest row per time and id."""
    rows = _day_range(compaction.stored_rows(spark, f"{root}/points", METRIC_POINT), start, end)
    return rows if every_copy else current_points(rows)


def compact(
    spark: SparkSession, root: str, up_to: int, least_batches: int = compaction.LEAST_BATCHES,
    rows_per_file: int = compaction.ROWS_PER_FILE,
) -> None:
    """Rewrite the days of events and points that hold many batches numbered up to ``up_to``.

    Those batches must be complete: while batch N runs, all below N are.
    """
    compaction.compact_days(
        spark, f"{root}/events", EVENT_ROWS, up_to, ["source", "type", "ts"], least_batches, rows_per_file
    )
    compaction.compact_days(
        spark, f"{root}/points", METRIC_POINT, up_to, ["service", "metric_name", "time"], least_batches, rows_per_file
    )


def latest_by_key(rows: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """The last written row per key; equal write times are settled by row content.

    An aggregation rather than a ranking window: copies of one key combine on
    the map side, so a key with very many copies never fills one task.
    """
    others = [c for c in rows.columns if c not in keys]
    content = F.xxhash64(F.to_json(F.struct(*rows.columns)))
    best = F.max_by(F.struct(*others), F.struct(*newest, content))
    return rows.groupBy(*keys).agg(best.alias("row")).select(*keys, "row.*").select(*rows.columns)


def current_events(rows: DataFrame) -> DataFrame:
    return latest_by_key(rows, ["id"], ["received_at"])


def current_points(rows: DataFrame) -> DataFrame:
    return latest_by_key(rows, ["time", "id"], ["batch"])

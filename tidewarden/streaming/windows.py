"""Windows handed on whole: a stream whose micro-batches hold complete windows.

Some results need two windowed steps over one window (group events by correlation id, then count what stands
behind each metric group). In append mode every group of a window is emitted
by the same micro-batch, so grouping by the window and the whole row gives micro-batches that hold
the complete rows of all windows that the watermark has passed, each window once. The
batch operators then run on them unchanged and exactly.

State holds the rows of open windows, one per distinct row with a count, spread by the row's own
hash: no key, however hot, fills one state partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.buckets import window_of
from ..operators import detect
from ..operators.correlate import correlated
from ..schemas import TELEMETRY_EVENT
from .streams import DEFAULT_DELAY, batch_writer

#: A row that occurs more often than this is written as several rows with a count.
COPIES = 10_000

_TAGS = next(f.dataType for f in TELEMETRY_EVENT.fields if f.name == "tags")
_CLOSED = T.StructType([*TELEMETRY_EVENT.fields, T.StructField("copies", T.LongType())])
ANOMALIES = T.StructType([
    T.StructField(name, {"score": T.DoubleType(), "detected_at": T.TimestampType()}.get(name, T.StringType()))
    for name in detect.ANOMALY_COLUMNS
])


def closed_windows(events: DataFrame, bucket: str = detect.DEFAULT_WINDOW, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Events of closed windows (append mode) with ``copies``, the number of equal rows."""
    plain = events.withWatermark("ts", delay).select(
        window_of("ts", bucket).alias("window"), "id", "source", "type", "subtype", "payload",
        # a map cannot be grouped by, and a stream groups by one event-time column: the window
        F.unix_micros("ts").alias("at"), "correlation_id", F.to_json("tags").alias("tags"),
    )
    counted = plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.select(
        "id", "source", "type", "subtype", "payload", F.timestamp_micros("at").alias("ts"), "correlation_id",
        F.from_json("tags", _TAGS).alias("tags"), "copies",
    )


def _each_copy(rows: DataFrame) -> DataFrame:
    """One row per event again; at most ``COPIES`` from one array."""
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES)))
    cut = rows.withColumn("_part", parts)
    here = F.least(F.lit(COPIES), F.col("copies") - F.col("_part") * COPIES)
    return cut.withColumn("_copy", F.explode(F.sequence(F.lit(1), here))).select(*TELEMETRY_EVENT.names)


def window_stream(
    events: DataFrame,
    operate: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    bucket: str = detect.DEFAULT_WINDOW,
    delay: str = DEFAULT_DELAY,
    available_now: bool = False,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Run a batch operator on the events of every closed window.

    ``root/windows/batch=N`` keeps the events of the windows that micro-batch N closed, ``root/rows/batch=N``
    what the operator makes of them. A retried batch replaces both of its folders.
    """

    def handle(batch: DataFrame, number: int) -> None:
        settle_windows(batch, number, operate, root)

    return batch_writer(closed_windows(events, bucket, delay), handle, checkpoint, available_now, every).start()


def settle_windows(batch: DataFrame, number: int, operate: Callable[[DataFrame], DataFrame], root: str) -> None:
    """Write the closed windows of one micro-batch, and the operator's rows read from there."""
    spark = batch.sparkSession
    closed = f"{root}/windows/batch={number}"
    batch.write.mode("overwrite").parquet(closed)
    events = _each_copy(spark.read.schema(_CLOSED).parquet(closed))
    operate(events).write.mode("overwrite").parquet(f"{root}/rows/batch={number}")


def enriched_context_stream(
    events: DataFrame, root: str, checkpoint: str, bucket: str = detect.DEFAULT_WINDOW,
    delay: str = DEFAULT_DELAY, available_now: bool = False, every: str = "5 seconds", **options,
) -> StreamingQuery:
    """Streaming form of ``detect.detect_enriched`` with its context: every hit carries how many distinct
    events and services its metric group's correlation groups hold in that window."""

    def operate(closed: DataFrame) -> DataFrame:
        return detect.detect_enriched(closed, bucket, **options)

    return window_stream(correlated(events), operate, root, checkpoint, bucket, delay, available_now, every)


def window_rows(spark: SparkSession, root: str, schema: T.StructType = ANOMALIES) -> DataFrame:
    """What the operator made of all windows closed so far."""
    return spark.read.schema(schema).parquet(f"{root}/rows")

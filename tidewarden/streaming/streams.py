"""Structured Streaming forms of the detectors, correlation, store and alerts.

Windows are event-time windows. A watermark is our addition: rows later than
``delay`` are dropped and a window is emitted once the watermark has passed it.

The z-score and correlation streams aggregate small statistics per window and
join them back to the rows of the window. Rows wait in join state spread over
``slices``, so one hot key does not fill one state partition; state is bounded by
window length plus delay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.buckets import window_of
from ..functions.skew import slice_of
from ..operators import detect
from ..operators.alerts import ALERT_COLUMNS, alert_candidates, apply_status_updates, create_alerts
from ..operators.correlate import correlated
from ..schemas import ALERT
from ..session import fresh_folder
from ..sources import store

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DEFAULT_DELAY = "1 minute"
DEFAULT_SLICES = 8
ALERT_BUCKETS = 64


def use_rocksdb(spark: SparkSession) -> None:
    """Keep operator state on local disk with changelog checkpoints instead of on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _join_back(
    rows: DataFrame, stats: DataFrame, keys: list[str], spread_on: list[str], slices: int
) -> DataFrame:
    """Rows with the statistics of their window group."""
    spread = slice_of(spread_on, F.lit(slices))
    copies = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    return rows.withColumn("_slice", spread).join(
        stats.withColumn("_slice", copies), [*keys, "_slice"]
    ).drop("_slice")


def _with_bounds(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    )


def raw_zscore_stream(
    events: DataFrame,
    bucket: str = detect.DEFAULT_WINDOW,
    delay: str = DEFAULT_DELAY,
    slices: int = DEFAULT_SLICES,
    detector: str = "raw-zscore",
    threshold: float = detect.Z_THRESHOLD,
    critical: float = detect.Z_CRITICAL,
) -> DataFrame:
    """Streaming form of ``detect.detect_raw`` (append mode)."""
    samples = detect.metric_samples(events.withWatermark("ts", delay)).withColumn(
        "window", window_of("ts", bucket)
    )
    keys = ["window", "source", "metric"]
    stats = (
        samples.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count("value").alias("samples"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("stddev"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .where(detect.can_fire(threshold, detect.MIN_SAMPLES, detect.MIN_STDDEV))
    )
    # A stream keeps one event-time column through a join; here that is the window.
    numeric = samples.where(F.col("value").isNotNull()).withColumn("ts", F.col("ts").alias("ts", metadata={}))
    scored = _join_back(numeric, stats, keys, ["event_id"], slices)
    hits = detect.hits_of(_with_bounds(scored), detector, threshold, critical)
    return hits.select(*detect.ANOMALY_COLUMNS)


def enriched_zscore_stream(events: DataFrame, **options) -> DataFrame:
    """Streaming form of ``detect.detect_enriched`` without the context counts.

    ``windows.enriched_context_stream`` gives the hits with them.
    """
    return raw_zscore_stream(correlated(events), detector="enriched-zscore", **options)


def correlate_stream(
    events: DataFrame,
    bucket: str = "1 minute",
    delay: str = DEFAULT_DELAY,
    slices: int = DEFAULT_SLICES,
) -> DataFrame:
    """Correlated events with window, group size and number of services (append mode).

    Sources are counted first per group and source, so no state holds a list.
    """
    rows = correlated(events.withWatermark("ts", delay)).withColumn(
        "window", window_of("ts", bucket)
    )
    keys = ["window", "correlation_id"]
    sizes = (
        rows.groupBy(*keys, "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg(F.sum("n").alias("correlated_count"), F.count("source").cast("int").alias("unique_services"))
    )
    # A stream keeps one event-time column through a join; here that is the window.
    plain = rows.withColumn("ts", F.col("ts").alias("ts", metadata={}))
    joined = _join_back(plain, sizes, keys, ["id"], slices)
    return _with_bounds(joined).drop("window")


def append_writer(
    frame: DataFrame, path: str, checkpoint: str, available_now: bool = False,
    every: str = "5 seconds",
) -> DataStreamWriter:
    """Parquet sink in append mode; the file sink records complete batches only."""
    writer = (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, available_now, every)


def _triggered(writer: DataStreamWriter, available_now: bool, every: str) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)


def batch_writer(
    frame: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    available_now: bool = False, every: str = "5 seconds",
) -> DataStreamWriter:
    """``foreachBatch`` query; a failed batch is retried as a whole with the same number."""
    writer = frame.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, every)


def store_stream(
    events: DataFrame, root: str, checkpoint: str, available_now: bool = False,
    every: str = "5 seconds", compact_every: int | None = None,
) -> StreamingQuery:
    """Store events and metric points of every micro-batch.

    With ``compact_every`` the days with that many batches are rewritten each time so many
    batches have passed; by then all earlier batches are complete.
    """

    def handle(batch: DataFrame, number: int) -> None:
        store.write_batch(batch, root, number)
        if compact_every and number and number % compact_every == 0:
            store.compact(batch.sparkSession, root, number - 1, compact_every)

    return batch_writer(events, handle, checkpoint, available_now, every).start()


def _bucket_of(alert_id: str) -> Column:
    return F.pmod(F.crc32(F.col(alert_id).cast("binary")), F.lit(ALERT_BUCKETS)).cast("int")


def _buckets_of(rows: DataFrame, alert_id: str) -> list[int]:
    """The alert buckets that a batch touches, at most ``ALERT_BUCKETS``."""
    found = rows.where(F.col(alert_id).isNotNull()).select(_bucket_of(alert_id).alias("b")).distinct()
    return [r.b for r in found.collect()]


def stored_alerts(
    spark: SparkSession, root: str, before: int | None = None, buckets: list[int] | None = None
) -> DataFrame:
    """Alerts written by earlier batches, of some buckets only if asked for.

    An empty store gives an empty frame.
    """
    places = [T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())]
    schema = T.StructType([*ALERT.fields, *places])
    try:
        rows = spark.read.schema(schema).parquet(root)
        rows.schema  # resolves the path
    except Exception as error:  # the first batch finds no folder yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], schema)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    rows = rows.drop("bucket")
    return rows if before is None else rows.where(F.col("batch") < before)


def _write_alerts(rows: DataFrame, number: int, root: str) -> None:
    (
        rows.select(*ALERT_COLUMNS)
        .withColumns({"bucket": _bucket_of("id"), "batch": F.lit(number).cast("bigint")})
        .repartition("bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "batch")
        .parquet(root)
    )


def write_alert_batch(batch: DataFrame, number: int, root: str) -> None:
    """Create the alerts of one micro-batch of insights.

    A retried batch looks only at batches before its own, so its own partial
    output cannot hide its alerts, and it overwrites its own files.
    """
    touched = _buckets_of(alert_candidates(batch), "id")
    known = stored_alerts(batch.sparkSession, root, number, touched)
    _write_alerts(create_alerts(batch, known), number, root)


def alert_stream(
    insights: DataFrame, root: str, checkpoint: str, available_now: bool = False,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Create alerts once per anomaly id, across batches and redeliveries."""

    def handle(batch: DataFrame, number: int) -> None:
        write_alert_batch(batch, number, root)

    return batch_writer(insights, handle, checkpoint, available_now, every).start()


def current_alerts(
    spark: SparkSession, root: str, changes: str, before: int | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Alerts in their latest state: as created, or as of the last batch that changed them.

    With ``ids`` (a column ``id``) only those alerts, read from their buckets only.
    """
    buckets = None if ids is None else _buckets_of(ids, "id")
    created = stored_alerts(spark, root, buckets=buckets).withColumn("batch", F.lit(-1).cast("bigint"))
    changed = stored_alerts(spark, changes, before, buckets)
    if ids is not None:
        created, changed = (rows.join(ids, "id", "left_semi") for rows in (created, changed))
    return store.latest_by_key(created.unionByName(changed), ["id"], ["batch"]).drop("batch")


def write_status_batch(updates: DataFrame, number: int, root: str, changes: str) -> None:
    """Append the new state of the alerts that one micro-batch of requests changes."""
    asked = updates.select(F.col("alert_id").alias("id")).distinct()
    current = current_alerts(updates.sparkSession, root, changes, number, asked)
    result = apply_status_updates(current, updates)
    touched = result.accepted.select(F.col("alert_id").alias("id")).distinct()
    _write_alerts(result.alerts.join(touched, "id", "left_semi"), number, changes)


def status_stream(
    updates: DataFrame, root: str, changes: str, checkpoint: str, available_now: bool = False,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Apply status requests to stored alerts; the alert table itself is never rewritten."""

    def handle(batch: DataFrame, number: int) -> None:
        write_status_batch(batch, number, root, changes)

    return batch_writer(updates, handle, checkpoint, available_now, every).start()


def run_to_table(frame: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream over what is available and return the written rows.

    The query has as many state partitions as the session has shuffle partitions at its
    first start; the number stays in the checkpoint.
    """
    spark = frame.sparkSession
    folder = fresh_folder(spark, label)
    writer = append_writer(frame, f"{folder}/rows", f"{folder}/checkpoint", available_now=True)
    query = writer.start()
    query.awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{folder}/rows")

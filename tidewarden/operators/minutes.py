"""Rollups kept as small rows that merge into any longer bucket.

A base row holds, per bucket, service and metric, what merges exactly (counts, sum, extremes) and a
KLL sketch of the values. Longer buckets are answered from base rows alone: all columns but
the percentiles are exact, those come with the error of their rank. The exact form over points is
``rollup.metric_rollup``, which stays the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import bucket_length, bucket_start, window_of
from ..functions.text import never_null
from ..schemas import DEFAULT_BUCKET
from .rollup import KEYS, PERCENTILES

#: Size of a sketch; a group of fewer values than this keeps them all.
SKETCH_SIZE = 800
_DAY = 86_400_000_000


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a percentile may be off, as a share of all values, in 99 of 100 cases.

    A fixed rule of KLL sketches; merging does not raise it.
    """
    return 2.296 / size**0.9021


def base_rows(points: DataFrame, bucket: str | None = DEFAULT_BUCKET, size: int = SKETCH_SIZE) -> DataFrame:
    """Rows that merge: cnt, samples (values that are not null), sum, min, max and sketch per bucket, service and metric.

    Batches may be reduced one by one: rows of one bucket from several batches merge as well.
    """
    kind = points.schema["time"].dataType
    epoch = F.lit("1970-01-01 00:00:00").cast(kind)
    keyed = points.where(F.col("time").isNotNull()).select(
        never_null(bucket_start(F.col("time"), bucket).cast(kind), epoch).alias("bucket"),
        never_null(F.col("service"), F.lit("")).alias("service"),
        never_null(F.col("metric_name"), F.lit("")).alias("metric_name"),
        "value",
    )
    return keyed.groupBy(*KEYS).agg(*_measures(size))


def base_stream(points: DataFrame, bucket: str | None = DEFAULT_BUCKET, delay: str = "1 minute", size: int = SKETCH_SIZE) -> DataFrame:
    """Streaming form of :func:`base_rows` (append mode); state is one row per open group."""
    rows = points.withWatermark("time", delay).select(
        window_of("time", bucket).alias("window"),
        never_null(F.col("service"), F.lit("")).alias("service"),
        never_null(F.col("metric_name"), F.lit("")).alias("metric_name"),
        "value",
    )
    made = rows.groupBy("window", "service", "metric_name").agg(*_measures(size))
    return made.withColumn("bucket", F.col("window.start")).drop("window").select(*KEYS, "cnt", "samples", "sum", "min", "max", "sketch")


def _measures(size: int) -> list:
    return [
        F.count(F.lit(1)).alias("cnt"), F.count("value").alias("samples"), F.sum("value").alias("sum"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"),
    ]


def _fits(base: str | None, bucket: str | None) -> bool:
    """Whether every base bucket lies in one longer bucket."""
    short_months, short = bucket_length(base)
    months, micros = bucket_length(bucket)
    if short_months:
        return months > 0 and months % short_months == 0
    return _DAY % short == 0 if months else micros % short == 0


def merged_rollup(base: DataFrame, bucket: str | None, base_bucket: str | None = DEFAULT_BUCKET, size: int = SKETCH_SIZE) -> DataFrame:
    """The columns of ``rollup.metric_rollup`` for longer buckets, from base rows, and ``rank_error``.

    Percentiles are values of the data whose rank is off by ``rank_error`` at most; groups without a
    value that can be ordered have none. Select base rows before to bound service, metric or time.
    """
    if not _fits(base_bucket, bucket):
        raise ValueError(f"buckets of {bucket!r} are not made of whole buckets of {base_bucket!r}")
    kind = base.schema["bucket"].dataType
    epoch = F.lit("1970-01-01 00:00:00").cast(kind)
    longer = never_null(bucket_start(F.col("bucket"), bucket).cast(kind), epoch).alias("bucket")
    wide = base.select(longer, "service", "metric_name", "cnt", "samples", "sum", "min", "max", "sketch").groupBy(*KEYS).agg(
        F.sum("cnt").alias("cnt"), F.sum("samples").alias("samples"), F.sum("sum").alias("sum"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"),
    )
    ordered = F.kll_sketch_get_n_double("sketch") > 0
    quantile = lambda p: F.when(ordered, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))
    return wide.select(
        *KEYS, F.try_divide("sum", "samples").alias("avg"), "min", "max",
        quantile(PERCENTILES[0]).alias("p95"), quantile(PERCENTILES[1]).alias("p99"), "cnt",
        F.lit(rank_error(size)).alias("rank_error"),
    )

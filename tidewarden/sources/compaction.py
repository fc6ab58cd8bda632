"""Compaction of a table stored by day and batch, behind a manifest.

A compaction writes whole days to ``<table>-compacted/version=V/event_date=D`` and then appends one file of
rows (event_date, version, up_to) to ``<table>-manifest``. A file is there or it is not, so readers see all of a
compaction or nothing of it. They take, per day, the rewritten rows of the
newest version in the manifest and the batches above its ``up_to``; both are conditions on partition
columns, decided before any file is opened. A batch that is retried after its compaction writes a folder that
nobody reads any more. A compaction that dies before its manifest row leaves a folder
that the next one overwrites.

One compaction runs at a time, and one writer numbers the batches of a store.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import read_or_empty, remove

LEAST_BATCHES = 100
ROWS_PER_FILE = 2_000_000
_DAY, _BATCH, _VERSION = (
    T.StructField("event_date", T.DateType()), T.StructField("batch", T.LongType()), T.StructField("version", T.LongType()),
)
MANIFEST = T.StructType([_DAY, _VERSION, T.StructField("up_to", T.LongType())])


class Compacted(NamedTuple):
    """Per day the newest version and the last batch in it; one entry per compacted day."""

    version: dict[dt.date, int]
    up_to: dict[dt.date, int]


def manifest(spark: SparkSession, table: str) -> Compacted:
    """What has been compacted. A few numbers per day of the store."""
    rows = read_or_empty(spark, f"{table}-manifest", MANIFEST)
    newest = rows.groupBy("event_date").agg(F.max(F.struct("version", "up_to")).alias("m")).collect()
    return Compacted({r.event_date: r.m.version for r in newest}, {r.event_date: r.m.up_to for r in newest})


def _by_day(numbers: dict[dt.date, int]) -> Column:
    """The number of the row's day, null for other days."""
    if not numbers:
        return F.lit(None).cast("bigint")
    pairs = [part for day, number in sorted(numbers.items()) for part in (F.lit(day), F.lit(number).cast("bigint"))]
    return F.create_map(*pairs)[F.col("event_date")]


def _raw(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, table, T.StructType([*schema.fields, _DAY, _BATCH]))


def _rewritten(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, f"{table}-compacted", T.StructType([*schema.fields, _BATCH, _VERSION, _DAY]))


def stored_parts(spark: SparkSession, table: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Batches and rewritten days, all of them."""
    return _raw(spark, table, schema), _rewritten(spark, table, schema)


def stored_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All stored copies of a table's rows, with ``event_date`` and ``batch``."""
    known = manifest(spark, table)
    raw = _raw(spark, table, schema)
    if not known.version:
        return raw
    fresh = raw.where(F.col("batch") > F.coalesce(_by_day(known.up_to), F.lit(-1)))
    whole = _rewritten(spark, table, schema).where(F.col("version") == _by_day(known.version))
    return whole.select(*fresh.columns).unionByName(fresh)


def compact_days(
    spark: SparkSession, table: str, schema: T.StructType, up_to: int, order: list[str],
    least_batches: int = LEAST_BATCHES, rows_per_file: int = ROWS_PER_FILE,
) -> list[dt.date]:
    """Rewrite the days that hold at least ``least_batches`` batches numbered up to ``up_to``.

    Files get about ``rows_per_file`` rows, cut by ranges of day and ``order``, so a hot day or source is cut as well. All copies of
    a row are kept. Returns the days that were rewritten.
    """
    known = manifest(spark, table)
    waiting = _raw(spark, table, schema).where(
        (F.col("batch") <= up_to) & (F.col("batch") > F.coalesce(_by_day(known.up_to), F.lit(-1)))
    )
    # partition columns only: of the files no more than the footers is read
    batches = waiting.select("event_date", "batch").distinct().groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
    days = sorted(r.event_date for r in batches.where(F.col("n") >= least_batches).collect())
    if not days:
        return []
    version = max(known.version.values(), default=0) + 1
    rows = stored_rows(spark, table, schema).where(F.col("event_date").isin(days) & (F.col("batch") <= up_to))
    files = max(1, -(-rows.count() // rows_per_file))
    (
        rows.repartitionByRange(files, "event_date", *order)
        .sortWithinPartitions("event_date", *order)
        .write.mode("overwrite")
        .partitionBy("event_date")
        .parquet(f"{table}-compacted/version={version}")
    )
    _enter(spark, table, [(day, version, up_to) for day in days])
    return days


def _enter(spark: SparkSession, table: str, entries: list[tuple]) -> None:
    """Add rows to the manifest, all in one file: the moment a compaction counts."""
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{table}-manifest")


def drop_covered(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Delete what readers of the newest manifest do not read: covered batches and replaced versions.

    Call it when no reader that began before the last compaction is left.
    """
    known = manifest(spark, table)
    covered = _raw(spark, table, schema).where(F.col("batch") <= _by_day(known.up_to))
    for row in covered.select("event_date", "batch").distinct().toLocalIterator():
        remove(spark, f"{table}/event_date={row.event_date}/batch={row.batch}")
    replaced = _rewritten(spark, table, schema).where(F.col("version") < _by_day(known.version))
    for row in replaced.select("event_date", "version").distinct().toLocalIterator():
        remove(spark, f"{table}-compacted/version={row.version}/event_date={row.event_date}")

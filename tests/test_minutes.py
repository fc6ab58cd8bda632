"""Rollups that merge."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.operators import minutes
from tidewarden.operators.rollup import metric_rollup
from tidewarden.schemas import METRIC_POINT

KEYS = ["bucket", "service", "metric_name"]


def points_of(spark, rows):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), f"p{i}", service, metric, v, None) for i, (s, service, metric, v) in enumerate(rows)], METRIC_POINT)


def by_key(frame):
    return {tuple(r[k] for k in KEYS): r.asDict() for r in frame.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(rng.randrange(9 * 86_400), rng.choice("ab"), rng.choice(["m", None]), rng.choice([rng.gauss(50, 20), None])) for _ in range(1500)]


@pytest.mark.parametrize("bucket", ["5 minutes", "1 hour", "7 days", "1 month"])
def test_merged_rows_equal_the_exact_rollup(spark, rows, bucket):
    points = points_of(spark, rows)
    made, exact = by_key(minutes.merged_rollup(minutes.base_rows(points), bucket)), by_key(metric_rollup(points, bucket))
    assert set(made) == set(exact)
    for key, row in made.items():
        wanted = exact[key]
        assert (row["cnt"], row["min"], row["max"]) == (wanted["cnt"], wanted["min"], wanted["max"])
        assert (row["avg"] is None) == (wanted["avg"] is None) and (row["avg"] is None or math.isclose(row["avg"], wanted["avg"], rel_tol=1e-12))
        assert (row["p95"] is None) == (wanted["p95"] is None)


@pytest.mark.parametrize("size", [50, 800])
def test_percentiles_are_within_the_stated_rank_error(spark, size):
    rng = random.Random(size)
    values = [rng.expovariate(1) for _ in range(20_000)]
    points = points_of(spark, [(i % 3600, "s", "m", v) for i, v in enumerate(values)])
    # merged twice: minutes to ten minutes, those to the hour
    row = minutes.merged_rollup(minutes.base_rows(points, size=size), "1 hour", size=size).first()
    for p, share in ((row.p95, 0.95), (row.p99, 0.99)):
        assert p in set(values)
        assert abs(sum(v <= p for v in values) / len(values) - share) <= row.rank_error
    assert row.rank_error == minutes.rank_error(size)


def test_rows_of_several_batches_merge(spark, rows):
    points = points_of(spark, rows)
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    batches = [minutes.base_rows(points.where(part == k)) for k in range(3)]
    together = batches[0].unionByName(batches[1]).unionByName(batches[2])
    made, whole = by_key(minutes.merged_rollup(together, "1 day")), by_key(minutes.merged_rollup(minutes.base_rows(points), "1 day"))
    for key, row in whole.items():
        assert math.isclose(made[key].pop("avg") or 0, row.pop("avg") or 0, rel_tol=1e-12) and made[key] == row


def test_odd_values_and_no_values(spark):
    points = points_of(spark, [(0, "s", "nan", math.nan), (1, "s", "inf", math.inf), (2, "s", "inf", 1.0), (3, "s", "null", None)])
    made = {k[2]: r for k, r in by_key(minutes.merged_rollup(minutes.base_rows(points), "1 hour")).items()}
    assert made["nan"]["p95"] is None and math.isnan(made["nan"]["max"])
    assert made["inf"]["p99"] == math.inf and made["inf"]["min"] == 1.0
    assert made["null"]["p95"] is None and made["null"]["avg"] is None and made["null"]["cnt"] == 1
    assert minutes.merged_rollup(minutes.base_rows(points_of(spark, [])), "1 hour").count() == 0


@pytest.mark.parametrize(("base", "bucket", "fits"), [
    ("1 minute", "1 hour", True), ("7 minutes", "1 hour", False), ("1 hour", "1 month", True), ("5 hours", "1 month", False),
    ("1 month", "1 year", True), ("1 month", "7 days", False), ("2 hours", "1 hour", False),
])
def test_buckets_must_be_whole(spark, base, bucket, fits):
    rows = minutes.base_rows(points_of(spark, []), base)
    if fits:
        assert minutes.merged_rollup(rows, bucket, base).count() == 0
    else:
        with pytest.raises(ValueError, match="whole buckets"):
            minutes.merged_rollup(rows, bucket, base)


def test_the_stream_gives_the_same_rows(spark, rows, tmp_path):
    points = points_of(spark, [*rows[:300], (30 * 86_400, "flush", "m", 1.0)])
    points.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(METRIC_POINT).parquet(str(tmp_path / "in"))
    writer = minutes.base_stream(stream, "1 hour").writeStream.format("parquet").trigger(availableNow=True)
    writer.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start().awaitTermination()
    made = minutes.merged_rollup(spark.read.parquet(str(tmp_path / "out")), "1 day", "1 hour")
    whole = minutes.merged_rollup(minutes.base_rows(points_of(spark, rows[:300]), "1 hour"), "1 day", "1 hour")
    assert {k: r["cnt"] for k, r in by_key(made).items()} == {k: r["cnt"] for k, r in by_key(whole).items()}

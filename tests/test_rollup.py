from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.functions.buckets import bucket_length, bucket_start
from tidewarden.operators.percentiles import distinct_values, exact_percentiles, value_counts
from tidewarden.operators.rollup import latest_rollup, metric_points, metric_rollup, select_points
from tidewarden.operators.search import match_events, search_events, storage_summary
from tidewarden.schemas import METRIC_POINT


def _points(spark, values, step=1):
    rows = [
        (T0 + dt.timedelta(seconds=i * step), f"p{i}", "svc", "cpu", v, None)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, METRIC_POINT)


def test_rollup_of_one_bucket(spark):
    row = metric_rollup(_points(spark, [1.0, 2.0, 3.0, 10.0])).collect()[0]
    assert (row.avg, row.min, row.max, row.cnt) == (4.0, 1.0, 10.0, 4)
    assert row.p95 == pytest.approx(8.95) and row.p99 == pytest.approx(9.79)


@pytest.mark.parametrize("inline_values", [0, 5, 1000])
def test_percentiles_match_interpolation(spark, inline_values):
    rng = random.Random(7)
    groups = {
        "normal": [rng.gauss(0, 50) for _ in range(400)],
        "constant": [3.25] * 100,
        "two": [1.0] * 99 + [2.0],
        "signs": [-1e-12, 0.0, 0.0, 1e-12, 5.0, -7.0],
        "wide": [10.0 ** rng.uniform(-200, 200) * rng.choice([-1, 1]) for _ in range(200)],
        "close": [1.0 + i * 2.0**-52 for i in range(50)],
        "single": [42.0],
    }
    rows = spark.createDataFrame(
        [(g, v) for g, vs in groups.items() for v in vs], "g string, v double"
    )
    values = distinct_values(rows, ["g"], "v")
    sizes = values.groupBy("g").agg(*value_counts())
    wanted = [0.0, 0.5, 0.95, 0.99, 1.0]
    made = exact_percentiles(values, sizes, ["g"], wanted, inline_values=inline_values).collect()
    assert {r.g for r in made} == set(groups)
    for row in made:
        expected = np.quantile(np.array(groups[row.g]), wanted)
        np.testing.assert_allclose(row.percentiles, expected, rtol=1e-12, atol=1e-13)


@pytest.mark.parametrize("inline_values", [0, 1000])
def test_rollup_ignores_null_values_but_counts_rows(spark, inline_values):
    points = _points(spark, [1.0, None, 3.0])
    row = metric_rollup(points, inline_values=inline_values).collect()[0]
    assert (row.avg, row.cnt, row.p95) == (2.0, 3, pytest.approx(2.9))
    empty = metric_rollup(_points(spark, [None])).collect()[0]
    assert empty.p95 is None and empty.cnt == 1


def test_range_is_inclusive_and_blank_filters_are_off(spark):
    points = _points(spark, [1.0, 2.0, 3.0])
    end = F.lit(T0 + dt.timedelta(seconds=2))
    assert select_points(points, start=F.lit(T0), end=end).count() == 3
    assert select_points(points, service=" ", metric_name=None).count() == 3
    assert select_points(points, service="other").count() == 0


@pytest.mark.parametrize("limit", [0, -5, None])
def test_limit_default_and_order(spark, limit):
    rows = latest_rollup(_points(spark, [float(i) for i in range(120)], step=60), limit=limit)
    buckets = [r.bucket for r in rows.collect()]
    assert len(buckets) == 100 and buckets == sorted(buckets, reverse=True)


@pytest.mark.parametrize(
    ("bucket", "moment", "start"),
    [
        ("7 days", "2024-01-10 13:00:00", "2024-01-08 00:00:00"),
        ("1 week", "2024-01-10 13:00:00", "2024-01-08 00:00:00"),
        ("", "2024-01-10 13:07:30", "2024-01-10 13:07:00"),
        ("1 month", "2024-03-31 23:00:00", "2024-03-01 00:00:00"),
        ("5 months", "2024-03-31 23:00:00", "2024-03-01 00:00:00"),
        ("1 year", "1999-05-05 00:00:00", "1999-01-01 00:00:00"),
        ("90 minutes", "2024-01-10 13:07:30", "2024-01-10 12:00:00"),
        ("01:30", "2024-01-10 13:07:30", "2024-01-10 12:00:00"),
    ],
)
def test_bucket_starts(spark, bucket, moment, start):
    frame = spark.createDataFrame([(moment,)], "m string").select(F.col("m").cast("timestamp").alias("t"))
    made = frame.select(bucket_start(F.col("t"), bucket).cast("timestamp").alias("s")).collect()[0].s
    assert str(made) == start


@pytest.mark.parametrize("bad", ["soon", "1 month 2 days", "5 parsecs", "1 minute!"])
def test_bad_buckets(bad):
    with pytest.raises(ValueError):
        bucket_length(bad)


def test_stored_points(make_events):
    made = metric_points(
        make_events(
            {"id": "a", "payload": None, "subtype": "cpu"},
            {"id": "b", "payload": '{"metric": "m", "value": "7"}'},
            {"id": "c", "payload": "{}", "subtype": None},
            {"id": "d", "payload": '{"metric": "m", "value": 7}'},
            {"id": "e", "type": "log", "payload": "{}"},
        )
    )
    points = {p.id: (p.metric_name, p.value) for p in made.points.collect()}
    assert points == {"a-m": ("cpu", 0.0), "b-m": ("m", 0.0), "d-m": ("m", 7.0)}
    assert [r.id for r in made.rejected.collect()] == ["c-m"]


def test_search(make_events):
    frame = make_events(
        {"id": "a", "payload": '{"message": "100 percent"}'},
        {"id": "b", "payload": '{"message": "done"}', "tags": {"note": "Full"}},
        {"id": "c", "payload": '{"message": "FULL"}'},
    )

    def found(text):
        return {r.id for r in match_events(frame, text=text).collect()}

    assert found("100%cent") == {"a"} and found("1_0") == {"a"}
    assert found("Full") == {"b"} and found("FULL") == {"c"}
    newest = search_events(frame, limit=2).collect()
    assert [r.id for r in newest] == ["c", "b"] and len(newest[0]) == 8
    inside = match_events(frame, start=F.lit(T0), end=F.lit(T0 + dt.timedelta(seconds=1)))
    assert inside.count() == 2


def test_storage_summary_counts_the_boundary(make_events):
    frame = make_events(
        {"at": 0, "payload": '{"value": 1}'}, {"at": 3600, "type": "log", "payload": "{}"}
    )
    as_of = F.lit(T0 + dt.timedelta(hours=1))
    row = storage_summary(frame, metric_points(frame).points, as_of).collect()[0]
    assert tuple(row) == (2, 1, 2, 1)


@pytest.mark.parametrize("inline_values", [200_000, 1])
def test_values_beyond_any_number_keep_the_rollup_alive(spark, inline_values):
    infinite, nan = float("inf"), float("nan")
    rows = [(T0, "a", "s", "m", v) for v in (1.0, 2.0, 3.0, infinite)]
    rows += [(T0, "b", "s", "n", v) for v in (-infinite, 1.0, 5.0, nan)]
    points = spark.createDataFrame(rows, "time timestamp, id string, service string, metric_name string, value double")
    made = {r.metric_name: r for r in metric_rollup(points, "1 hour", inline_values=inline_values).collect()}
    assert (made["m"]["min"], made["m"]["max"], made["m"].cnt) == (1.0, infinite, 4)
    assert made["n"]["min"] == -infinite and made["n"].cnt == 4


def test_one_formula_for_both_percentile_paths(spark):
    rows = [(T0, str(i), "s", "m", 0.1 * i * i + 1 / (i + 3)) for i in range(97)]
    points = spark.createDataFrame(rows, "time timestamp, id string, service string, metric_name string, value double")
    small = metric_rollup(points, "1 hour").collect()[0]
    large = metric_rollup(points, "1 hour", inline_values=1).collect()[0]
    assert (small.p95, small.p99) == (large.p95, large.p99)

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import T0
from tidewarden.functions.skew import join_groups, small_group_rows
from tidewarden.operators.correlate import (
    correlate,
    correlation_groups,
    correlation_members,
    correlation_services,
    member_chunks,
)


def _three(make_events):
    return make_events(
        {"id": "b", "at": 5, "correlation_id": "c", "source": "web"},
        {"id": "a", "at": 9, "correlation_id": "c", "source": "db"},
        {"id": "z", "at": 1, "correlation_id": "c", "source": "web"},
        {"id": "n", "at": 61, "correlation_id": "c"},
        {"id": "x", "correlation_id": " "},
        {"id": "y", "correlation_id": "\t"},
        {"id": "w", "correlation_id": None},
    )


def test_groups_by_id_and_minute(make_events):
    rows = {r.id: r for r in correlate(_three(make_events)).collect()}
    assert set(rows) == {"a", "b", "z", "n"}
    assert rows["a"].correlated_count == 3 and rows["a"].unique_services == 2
    assert rows["n"].correlated_count == 1
    assert rows["n"].window_start == T0 + dt.timedelta(minutes=1)
    assert rows["n"].window_end == T0 + dt.timedelta(minutes=2)


def test_null_ids_count_but_are_not_listed(make_events):
    frame = make_events(
        {"id": None, "at": 1, "correlation_id": "c"}, {"id": "b", "at": 2, "correlation_id": "c"}
    )
    rows = correlate(frame).collect()
    assert len(rows) == 2
    assert all(r.correlated_count == 2 for r in rows)
    assert [m.member_id for m in correlation_members(frame).collect()] == ["b"]


def test_a_large_group_loses_nothing(spark, make_events):
    small = make_events({"id": "x", "correlation_id": "c"})
    events = spark.range(5000).select(
        F.concat(F.lit("e"), F.col("id")).alias("id"),
        F.concat(F.lit("s"), F.col("id") % 7).alias("source"),
        F.lit("log").alias("type"), F.lit("x").alias("subtype"), F.lit("{}").alias("payload"),
        F.lit(T0).alias("ts"), F.lit("c").alias("correlation_id"),
        F.lit(None).cast("map<string,string>").alias("tags"),
    ).select(*small.columns)
    rows = correlate(events)
    assert rows.count() == 5000
    assert rows.select("correlated_count", "unique_services").distinct().collect() == [(5000, 7)]
    assert correlation_members(events).count() == 5000
    assert {(s.source, s.events) for s in correlation_services(events).collect()} == {
        (f"s{i}", 715 if i < 2 else 714) for i in range(7)
    }
    chunks = member_chunks(events, length=100).collect()
    listed = [m.member_id for c in chunks for m in c.members]
    assert sorted(listed) == sorted(f"e{i}" for i in range(5000))
    assert len(chunks) == 50 and max(len(c.members) for c in chunks) < 200


def test_group_table(make_events):
    groups = correlation_groups(_three(make_events)).orderBy("window_start").collect()
    assert [(g.correlated_count, g.unique_services) for g in groups] == [(3, 2), (1, 1)]


def test_hot_group_is_cut_into_slices_without_losing_rows(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        "id",
    )
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    joined = join_groups(rows, sizes, ["k"], "n", ["id"], slice_rows=10)
    plain = rows.join(sizes, "k")
    assert joined.select("k", "id", "top").exceptAll(plain.select("k", "id", "top")).count() == 0
    assert joined.count() == 3000
    kept = join_groups(rows, sizes, ["k"], "n", ["id"], keep=F.col("k") != "hot", slice_rows=10)
    assert kept.count() == 2000
    assert small_group_rows(rows, sizes, ["k"], "n", 500).count() == 2000

"""Positions within groups of any size, and records cut by position."""

from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from tidewarden.functions.positions import with_positions
from tidewarden.operators.correlate import (
    context_id_chunks, context_links, correlated, ordered_member_chunks,
)
from tidewarden.operators.detect import firing_groups, windowed_samples


@pytest.mark.parametrize("partitions", [1, 3, 40, None])
def test_positions_count_within_groups_that_span_partitions(spark, partitions):
    n = 3000
    # one group holds two thirds of all rows
    group = F.when(F.col("id") % 3 == 0, F.concat(F.lit("g"), F.col("id") % 50)).otherwise(F.lit("hot"))
    rows = spark.range(n).select(group.alias("k"), F.xxhash64("id").alias("v"), F.col("id").alias("payload"))
    found = with_positions(rows, ["k"], [-F.col("v")], partitions)
    assert set(found.columns) == {"k", "v", "payload", "position"} and found.count() == n
    by_group = collections.defaultdict(list)
    for r in found.collect():
        by_group[r.k].append((r.position, r.v))
    for rows_of_group in by_group.values():
        rows_of_group.sort()
        assert [p for p, _ in rows_of_group] == list(range(len(rows_of_group)))
        values = [v for _, v in rows_of_group]
        assert values == sorted(values, reverse=True)


def test_no_rows_have_no_positions(spark):
    assert with_positions(spark.range(0).withColumn("k", F.lit(1)), ["k"], ["id"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_records_one_after_the_other_are_the_list(spark, make_events, partitions):
    rows = [{"id": f"e{(i * 7) % 31}", "at": (i * 11) % 40, "correlation_id": f"c{i % 2}"} for i in range(62)]
    rows += [{"id": "same", "at": 5, "correlation_id": "c0"}] * 3
    rows += [{"id": None, "correlation_id": "c0"}, {"id": "blank", "correlation_id": " "}]
    made = ordered_member_chunks(make_events(*rows), length=5, partitions=partitions)
    lists = collections.defaultdict(list)
    sizes = collections.defaultdict(list)
    for r in sorted(made.collect(), key=lambda r: r.chunk):
        sizes[r.correlation_id].append(len(r.members))
        lists[r.correlation_id] += [m.member_id for m in r.members for _ in range(m.copies)]
    for c in ("c0", "c1"):
        kept = sorted((r["at"], r["id"]) for r in rows if r["correlation_id"] == c and r["id"])
        assert lists[c] == [i for _, i in kept]
        assert set(sizes[c][:-1]) == {5} and 1 <= sizes[c][-1] <= 5


def test_another_column_can_give_the_order(make_events):
    rows = [{"id": f"e{i}", "at": i, "correlation_id": "c"} for i in range(6)]
    events = make_events(*rows).withColumn("received", -F.unix_timestamp("ts"))
    made = ordered_member_chunks(events, length=10, order="received").collect()
    assert [m.member_id for m in made[0].members] == [f"e{i}" for i in range(5, -1, -1)]


def test_context_ids_are_sorted_distinct_and_whole(make_events):
    rows = [
        {"id": f"v{i}", "payload": f'{{"metric": "m", "value": {v}}}', "correlation_id": f"c{i % 2}", "source": "web", "at": i}
        for i, v in enumerate([1] * 30 + [99])
    ]
    rows += [{"id": f"log{i}", "type": "log", "payload": "{}", "correlation_id": f"c{i % 3}", "at": i} for i in range(30)]
    rows += [{"id": "log0", "type": "log", "payload": "{}", "correlation_id": "c1", "at": 9}]
    events = correlated(make_events(*rows))
    samples = windowed_samples(events, "1 minute")
    links = context_links(firing_groups(samples), samples)
    made = sorted(context_id_chunks(links, events, "1 minute", length=7, partitions=5).collect(), key=lambda r: r.chunk)
    ids = [i for r in made for i in r.ids]
    assert ids == sorted({r["id"] for r in rows if r["correlation_id"] in ("c0", "c1")})
    assert all(len(r.ids) == 7 for r in made[:-1])

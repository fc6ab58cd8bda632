"""Whole windows of a stream, and the enriched hits with their context."""

from __future__ import annotations

import json

import pytest

from tests.conftest import T0
from tidewarden.operators.detect import detect_enriched
from tidewarden.schemas import TELEMETRY_EVENT
from tidewarden.streaming import windows

FLUSH = {"id": "flush", "source": "flush", "at": 7200, "payload": '{"value": 0}', "correlation_id": "flush"}


def window_of_events(start: int, name: str) -> list[dict]:
    """Thirty-one metrics of one source in two correlation groups, an outlier, and logs of other services."""
    rows = [
        {"id": f"{name}{i}", "payload": f'{{"metric": "m", "value": {v}}}', "correlation_id": f"c{i % 2}",
         "source": "web", "at": start + i}
        for i, v in enumerate([1] * 30 + [99])
    ]
    rows += [
        {"id": f"{name}-log{i}", "type": "log", "payload": "{}", "correlation_id": f"c{i % 3}", "source": f"s{i}", "at": start + i}
        for i in range(6)
    ]
    # the same id in both groups counts once; one row comes twice; one stands alone
    rows += [{"id": f"{name}-both", "type": "log", "payload": "{}", "correlation_id": c, "source": "twin", "at": start} for c in ("c0", "c1")]
    rows += [{"id": f"{name}-twice", "type": "log", "payload": "{}", "correlation_id": "c0", "source": "web", "at": start, "tags": {"a": "b"}}] * 2
    return rows + [{"id": f"{name}-alone", "payload": '{"metric": "m", "value": 1}', "source": "web", "at": start}]


def counts(rows):
    return {(r.event_id, json.loads(r.details)["correlatedCount"], json.loads(r.details)["uniqueServices"]) for r in rows}


def feed(spark, frame, folder):
    frame.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(TELEMETRY_EVENT).parquet(str(folder))


def test_hits_carry_the_counts_of_the_batch_form_across_a_restart(spark, make_events, tmp_path):
    first, second = window_of_events(0, "a"), window_of_events(60, "b")
    home = str(tmp_path / "out")

    def run(rows):
        stream = feed(spark, make_events(*rows), tmp_path / "in")
        windows.enriched_context_stream(stream, home, f"{home}/checkpoint", available_now=True).awaitTermination()

    run(first + second[:20])  # stops while the second window is open
    assert windows.window_rows(spark, home).count() == 0
    run([*second[20:], {**FLUSH, "at": 200}])
    made = windows.window_rows(spark, home)
    assert counts(made.collect()) == {("a30", 31 + 4 + 1 + 1, 6), ("b30", 31 + 4 + 1 + 1, 6)}
    run([FLUSH])  # nothing is handed on twice
    batch = detect_enriched(make_events(*first, *second))
    assert made.select(*batch.columns).exceptAll(batch).count() == 0
    assert batch.exceptAll(made.select(*batch.columns)).count() == 0
    assert windows.window_rows(spark, home).count() == 2


def test_a_retried_batch_replaces_its_own_folders(spark, make_events, tmp_path):
    from pyspark.sql import functions as F

    home = str(tmp_path / "out")
    batch = make_events(*window_of_events(0, "a")).withColumn("copies", F.lit(1).cast("long"))
    for frame in (batch.limit(10), batch, batch):
        windows.settle_windows(frame, 7, detect_enriched, home)
    assert windows.window_rows(spark, home).count() == 1
    assert spark.read.parquet(f"{home}/windows").count() == batch.count()


@pytest.mark.parametrize("copies", [1, windows.COPIES, 2 * windows.COPIES + 1])
def test_copies_become_rows_again(spark, make_events, copies):
    from pyspark.sql import functions as F

    rows = make_events({"id": "x"}).withColumn("copies", F.lit(copies).cast("long"))
    assert windows._each_copy(rows).count() == copies


def test_state_is_grouped_by_whole_rows(spark, make_events, tmp_path):
    """Every row comes back with its tags and time; rows without a time cannot be placed."""
    rows = [{"id": "x", "tags": {"a": "1"}, "correlation_id": "c", "at": 3}, {"id": None, "source": None, "payload": None, "correlation_id": "c", "at": 4}]
    stream = feed(spark, make_events(*rows, FLUSH), tmp_path / "in")
    kept = []
    windows.window_stream(
        stream, lambda closed: closed, str(tmp_path / "out"), str(tmp_path / "check"), available_now=True
    ).awaitTermination()
    kept = windows.window_rows(spark, str(tmp_path / "out"), TELEMETRY_EVENT).collect()
    assert {(r.id, r.source, str(r.tags), (r.ts - T0).total_seconds()) for r in kept} == {
        ("x", "engine-1", "{'a': '1'}", 3.0), (None, None, "None", 4.0),
    }

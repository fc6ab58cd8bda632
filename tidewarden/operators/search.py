"""Event search and storage summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import within
from .rollup import effective_limit

RESULT_COLUMNS = [
    "id", "source", "type", "subtype", "ts", "correlation_id", "payload", "tags",
]


def match_events(
    events: DataFrame,
    source: str | None = None,
    type: str | None = None,
    subtype: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
    text: str | None = None,
) -> DataFrame:
    """Filters only: null switches a filter off; the time range is inclusive at both ends and
    may have one end only. On stored events it also bounds the partitions read.

    ``text`` is looked for in the payload and the tags as JSON text, case-sensitive;
    ``%`` and ``_`` in it act as wildcards.
    """
    for name, wanted in (("source", source), ("type", type), ("subtype", subtype)):
        if wanted is not None:
            events = events.where(F.col(name) == wanted)
    events = within(events, "ts", start, end)
    if text is not None:
        pattern = f"%{text}%"
        events = events.where(
            F.col("payload").like(pattern) | F.to_json("tags").like(pattern)
        )
    return events


def search_events(events: DataFrame, limit: int | None = None, **filters) -> DataFrame:
    """Newest matching events, eight result columns, limited."""
    return (
        match_events(events, **filters)
        .select(*RESULT_COLUMNS)
        .orderBy(F.desc("ts"), "id")
        .limit(effective_limit(limit))
    )


def storage_summary(events: DataFrame, points: DataFrame, as_of: Column) -> DataFrame:
    """One row: total events and metrics, and those since an hour before ``as_of``.

    Totals ask for no column, so of stored files only the row counts in their footers
    are read. The last hour reads the time column of the days that it touches.
    """
    since = as_of - F.expr("INTERVAL 1 HOUR")

    def count(rows: DataFrame) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("n"))

    def recent(rows: DataFrame, time: str) -> Column:
        return count(within(rows, time, since, None)).select("n").scalar()

    return count(events).select(
        F.col("n").alias("total_events"),
        count(points).select("n").scalar().alias("total_metrics"),
        recent(events, "ts").alias("events_last_hour"),
        recent(points, "time").alias("metrics_last_hour"),
    )

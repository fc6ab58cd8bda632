"""Time buckets: interval text to a bucket-start column.

Fixed-length buckets count from Monday 2000-01-03 and month buckets from
2000-01-01, so a seven-day bucket starts on a Monday.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_MONTHS = {"month": 1, "year": 12}
# Short unit spellings.
_SHORT = {
    "us": "microsecond", "ms": "millisecond", "s": "second", "sec": "second", "m": "minute",
    "min": "minute", "h": "hour", "hr": "hour", "d": "day", "w": "week", "mon": "month",
    "y": "year", "yr": "year",
}
_ORIGIN_DAYS = 10_959  # 1970-01-01 to 2000-01-03


def bucket_length(text: str | None, default: str = "1 minute") -> tuple[int, int]:
    """Interval text as ``(months, microseconds)``; blank text means the default."""
    body = (text or "").strip().lower() or default
    months = micros = 0
    clock = re.fullmatch(r"(\d+):(\d{2})(?::(\d{2}))?", body)
    if clock:
        hours, minutes, seconds = (int(g or 0) for g in clock.groups())
        micros = (hours * 3600 + minutes * 60 + seconds) * 1_000_000
    else:
        pieces = re.findall(r"(\d+)\s*([a-z]+)", body)
        if not pieces or re.sub(r"(\d+)\s*([a-z]+)|[\s,]", "", body):
            raise ValueError(f"not an interval: {text!r}")
        for count, unit in pieces:
            unit = _SHORT.get(unit, _SHORT.get(unit.rstrip("s"), unit.rstrip("s")))
            if unit in _MONTHS:
                months += int(count) * _MONTHS[unit]
            elif unit in _MICROS:
                micros += int(count) * _MICROS[unit]
            else:
                raise ValueError(f"unknown unit in interval: {text!r}")
    if (months > 0) == (micros > 0):
        raise ValueError(f"a bucket is either months or a fixed length: {text!r}")
    return months, micros


def duration(micros: int) -> str:
    return f"{micros} microseconds"


def window_of(ts: Column | str, bucket: str | None) -> Column:
    """Tumbling window struct for a fixed-length bucket, usable in batch and stream."""
    months, micros = bucket_length(bucket)
    if months:
        raise ValueError("month buckets have no fixed length; use bucket_start")
    origin = (_ORIGIN_DAYS * _MICROS["day"]) % micros
    return F.window(ts, duration(micros), startTime=duration(origin))


def window_bounds(ts: Column | str, bucket: str | None, kind: DataType) -> list[Column]:
    """Non-null ``window_start`` and ``window_end`` columns for batch plans.

    ``window`` itself drops rows without a time, so the stand-in value is never seen.
    """
    w = window_of(ts, bucket)
    epoch = F.lit("1970-01-01 00:00:00").cast(kind)
    return [F.coalesce(w[part], epoch).alias(f"window_{part}") for part in ("start", "end")]


def bucket_start(ts: Column, bucket: str | None) -> Column:
    """Start of the bucket that holds ``ts``."""
    months, _ = bucket_length(bucket)
    if not months:
        return window_of(ts, bucket)["start"]
    index = (F.year(ts) - 2000) * 12 + F.month(ts) - 1
    behind = F.pmod(index, F.lit(months))
    return F.add_months(F.trunc(ts, "month"), -behind)


def within(rows: DataFrame, time: str, start: Column | None, end: Column | None) -> DataFrame:
    """Rows of a time range, by day as well where the rows carry ``event_date``."""
    dated = "event_date" in rows.columns
    if start is not None:
        rows = rows.where(F.col(time) >= start)
        rows = rows.where(F.col("event_date") >= F.to_date(start)) if dated else rows
    if end is not None:
        rows = rows.where(F.col(time) <= end)
        rows = rows.where(F.col("event_date") <= F.to_date(end)) if dated else rows
    return rows

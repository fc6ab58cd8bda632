"""String, time and id expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A character outside the platform's whitespace set, and one above the space.
NON_WHITESPACE = (
    "[^\\t-\\r\\x1C-\\x20\\u1680\\u2000-\\u2006\\u2008-\\u200A\\u2028\\u2029\\u205F\\u3000]"
)
ABOVE_SPACE = "[^\\x00-\\x20]"


def has_text(col: Column | str) -> Column:
    """True when the value holds any non-whitespace character; null counts as blank."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).rlike(NON_WHITESPACE)


def is_filled(col: Column | str) -> Column:
    """Request-field rule: something is left after trimming control characters and spaces."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).rlike(ABOVE_SPACE)


def text_or_null(col: Column) -> Column:
    """``null`` printed as the word, the way a string formatter shows a missing value."""
    return F.coalesce(col, F.lit("null"))


def never_null(col: Column, default: Column) -> Column:
    """Declare a grouping key non-null; the default stands in for a missing value."""
    return F.coalesce(col, default)


def iso_instant(col: Column) -> Column:
    """ISO-8601 instant with 0, 3 or 6 fraction digits, whichever is exact.

    A TIMESTAMP is an instant and printed in UTC whatever the session's zone; a
    TIMESTAMP_NTZ is taken to be UTC already.
    """
    seconds = F.unix_micros(col.cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    instant = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since
    utc = F.when(F.typeof(col) == "timestamp", instant).otherwise(col.cast("timestamp_ntz"))
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(utc, "SSSSSS")
    fraction = (
        F.when(micros == "000000", F.lit(""))
        .when(micros.endswith("000"), F.concat(F.lit("."), F.substring(micros, 1, 3)))
        .otherwise(F.concat(F.lit("."), micros))
    )
    return F.concat(whole, fraction, F.lit("Z"))


def stable_id(*parts: Column) -> Column:
    """32 hex digits that depend only on the parts, so a replay gives the same id.

    The parts are hashed as a JSON list: nulls keep their place and no text can
    look like two parts.
    """
    listed = F.to_json(F.array(*[p.cast("string") for p in parts]))
    return F.substring(F.sha2(listed, 256), 1, 32)


def without_id(given: Column, *instead: Column | str) -> Column:
    """What tells rows apart that have no id of their own, as JSON; null where one is given."""
    parts = [F.col(p) if isinstance(p, str) else p for p in instead]
    content = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
    return F.when(given.isNull(), F.to_json(content, {"ignoreNullFields": "false"}))


def json_object(**fields: Column) -> Column:
    """JSON text that keeps keys whose value is null."""
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in fields.items()]),
        {"ignoreNullFields": "false"},
    )

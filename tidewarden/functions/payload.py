"""Typed reads from the open JSON payload.

A payload is parsed once, against a declared schema that asks for numbers as
DOUBLE and texts as STRING. The parser then gives null for a number field that
holds a JSON string, boolean or object, which is the type test the detectors
need; no cast could tell ``5`` from ``"5"``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC_FIELDS = "metric STRING, value DOUBLE"
LOG_FIELDS = "level STRING, message STRING"
TRACE_FIELDS = "durationMs DOUBLE, operation STRING"


def read_fields(fields: str | T.StructType, payload: Column | str = "payload") -> Column:
    """Struct of the named fields; all null where the payload is no JSON object."""
    return F.from_json(payload, fields, {"allowNonNumericNumbers": "false"})


def with_fields(rows: DataFrame, fields: str, name: str = "fields") -> DataFrame:
    """Add the struct of payload fields as ``name``."""
    return parse_once(rows, read_fields(fields), name)


def parse_once(rows: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add an expensive column so that it is computed once per row.

    Filters on a plain column are pushed below it, with a copy of its expression;
    they cannot move below a generator.
    """
    return rows.select("*", F.explode(F.array(parsed)).alias(name))


def metric_name(payload: Column, fields: Column, subtype: Column) -> Column:
    """Name used by the detectors: no payload at all hides even the subtype."""
    return F.when(payload.isNull(), F.lit("unknown")).otherwise(
        F.coalesce(fields["metric"], subtype, F.lit("unknown"))
    )


def stored_metric_name(fields: Column, subtype: Column) -> Column:
    """Name kept in the metric table: falls back to the subtype, may stay null."""
    return F.coalesce(fields["metric"], subtype)


def stored_value(fields: Column) -> Column:
    return F.coalesce(fields["value"], F.lit(0.0))

"""Threshold rules kept as rows of a table, with the text of their parts in SQL.

A rule row names the event type it looks at, the payload fields it reads and, as SQL
over those fields, when it fires and what it reports. Fields are plain columns in the text; the
event's own columns are fields of the struct ``event``. A row is valid from one time (included) to another (excluded), so a table
holds all versions of a rule and an event is judged by the version of its own time.

Rows are parsed and checked one by one against an empty frame of the declared fields; what is
wrong with a bad one is reported, and the others stay. All good rules are then evaluated in one pass with one
parse of the payload; nothing is shuffled. Arithmetic in rule texts never fails a job: overflow, division by
zero and casts that do not fit give null or saturate, and null does not fire.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import payload as P
from ..functions.text import stable_id, without_id
from ..schemas import TELEMETRY_EVENT
from .detect import ANOMALY_COLUMNS

RULE = T.StructType([
    *[
        T.StructField(name, T.StringType())
        for name in (
            "name", "metric", "event_type", "fields", "predicate", "score", "severity", "description", "details",
        )
    ],
    T.StructField("valid_from", T.TimestampType()),
    T.StructField("valid_to", T.TimestampType()),
])
#: A rule table is configuration and compiled on the driver; a larger one is refused.
MOST_RULES = 2_000

_PARTS = {
    "predicate": T.BooleanType(), "score": T.DoubleType(), "severity": T.StringType(),
    "description": T.StringType(), "details": T.StringType(),
}
_REJECT = T.StructType([*RULE.fields, T.StructField("reject_reason", T.StringType())])
_EVENT = T.StructType([f for f in TELEMETRY_EVENT.fields if f.name != "payload"])


class RuleSet(NamedTuple):
    """Rules that can run, and the rows that cannot with the reason."""

    rules: list[Row]
    fields: dict[str, T.DataType]
    rejected: DataFrame


@contextmanager
def _forgiving(spark: SparkSession) -> Iterator[None]:
    """Expressions resolved inside follow the rules of SQL that give null instead of failing."""
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _declared(text: str | None) -> dict[str, T.DataType]:
    """Payload fields of a rule; names that differ in case only would be one column."""
    if text is None or not text.strip():
        raise ValueError("no fields")
    found = T.StructType.fromDDL(text)
    names = [f.name.lower() for f in found]
    if len(set(names)) < len(names):
        raise ValueError("a field is declared twice")
    if "event" in names:
        raise ValueError("a field cannot be called event")
    return {f.name: f.dataType for f in found}


def _check(spark: SparkSession, rule: Row, known: dict[str, T.DataType]) -> dict[str, T.DataType]:
    """The rule's fields; raises with the reason where the rule cannot run beside the known ones."""
    for name in ("name", "metric", "event_type"):
        if not (rule[name] or "").strip():
            raise ValueError(f"no {name}")
    if rule.valid_from and rule.valid_to and rule.valid_to <= rule.valid_from:
        raise ValueError("valid_to is not after valid_from")
    fields = _declared(rule.fields)
    spelled = {name.lower(): name for name in known}
    for name, kind in fields.items():
        other = spelled.get(name.lower())
        if other is not None and (other != name or known[other] != kind):
            raise ValueError(f"field {name} is declared differently by another rule")
    shape = T.StructType([T.StructField("event", _EVENT), *[T.StructField(n, k) for n, k in fields.items()]])
    nothing = spark.createDataFrame([], shape)
    for part, wanted in _PARTS.items():
        if not (rule[part] or "").strip():
            raise ValueError(f"no {part}")
        try:
            # a filter takes no aggregate, window or generator
            nothing.where(F.expr(rule[part]).isNotNull()).schema
            made = nothing.select(F.expr(rule[part]).alias("x")).schema["x"].dataType
        except PySparkException as error:
            raise ValueError(f"{part}: {str(error).strip().splitlines()[0]}") from error
        numeric = isinstance(wanted, T.DoubleType) and isinstance(made, T.NumericType)
        if made != wanted and not numeric:
            raise ValueError(f"{part} is of type {made.simpleString()}, not {wanted.simpleString()}")
    return fields


def _overlaps(a: Row, b: Row) -> bool:
    starts_before = a.valid_from is None or b.valid_to is None or a.valid_from < b.valid_to
    ends_after = a.valid_to is None or b.valid_from is None or b.valid_from < a.valid_to
    return starts_before and ends_after


def compile_rules(table: DataFrame) -> RuleSet:
    """Check every row of a rule table.

    A bad row goes to ``rejected`` with a reason. Of two versions of a rule that are valid
    at one time the one that starts first stays, an open start being the earliest.
    """
    spark = table.sparkSession
    rows = table.select(*RULE.names).limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"a rule table holds {MOST_RULES} rows at most")
    start = lambda r: (r.valid_from is not None, r.valid_from)
    rows = sorted(rows, key=lambda r: (r.name or "", start(r)[0], r.valid_from.timestamp() if r.valid_from else 0.0))
    good: list[Row] = []
    bad: list[tuple] = []
    fields: dict[str, T.DataType] = {}
    with _forgiving(spark):
        for rule in rows:
            try:
                own = _check(spark, rule, fields)
                if any(r.name == rule.name and _overlaps(r, rule) for r in good):
                    raise ValueError("overlaps an earlier version of the rule")
            except (ValueError, PySparkException) as error:
                bad.append((*rule, str(error).strip().splitlines()[0]))
                continue
            good.append(rule)
            fields.update(own)
    return RuleSet(good, fields, spark.createDataFrame(bad, _REJECT))


def _valid(rule: Row) -> Column:
    ts = F.col("event.ts").cast("timestamp")
    valid = F.lit(True)
    if rule.valid_from is not None:
        valid &= ts >= F.lit(rule.valid_from)
    if rule.valid_to is not None:
        valid &= ts < F.lit(rule.valid_to)
    return valid


def _anomaly(rule: Row) -> Column:
    """Struct of one rule's anomaly, null where the rule does not fire."""
    own = F.struct(*[F.col(f"`{name}`") for name in _declared(rule.fields)])
    made = {
        "id": stable_id(F.lit(rule.name), F.col("event.source"), F.lit(rule.metric), F.col("event.id"),
                        without_id(F.col("event.id"), "event.ts", own)),
        "service": F.col("event.source"),
        "metric": F.lit(rule.metric),
        "score": F.expr(rule.score).cast("double"),
        "severity": F.expr(rule.severity),
        "description": F.expr(rule.description),
        "detected_at": F.col("event.ts"),
        "details": F.expr(rule.details),
        "correlation_id": F.col("event.correlation_id"),
        "detector": F.lit(rule.name),
        "event_id": F.col("event.id"),
    }
    fires = (F.col("event.type") == rule.event_type) & _valid(rule) & F.expr(rule.predicate)
    return F.when(fires, F.struct(*[made[name].alias(name) for name in ANOMALY_COLUMNS]))


def detect_rule_rows(events: DataFrame, rules: RuleSet) -> DataFrame:
    """Anomalies of all rules, one row per rule that fires on an event; for batches and streams.

    Events without a time are judged by the rules that are always valid only.
    """
    if not rules.rules:
        kinds = {"score": "double", "detected_at": events.schema["ts"].dataType}
        none = [F.lit(None).cast(kinds.get(name, "string")).alias(name) for name in ANOMALY_COLUMNS]
        return events.where(F.lit(False)).select(*none)
    wanted = events.where(F.col("type").isin(*sorted({r.event_type for r in rules.rules})))
    schema = T.StructType([T.StructField(n, k) for n, k in rules.fields.items()])
    event = F.struct(*[F.col(name) for name in _EVENT.names])
    both = F.struct(event.alias("event"), P.read_fields(schema).alias("fields"))
    rows = P.parse_once(wanted, both, "both").select("both.event", "both.fields.*")
    with _forgiving(events.sparkSession):
        found = F.array_compact(F.array(*[_anomaly(rule) for rule in rules.rules]))
        return rows.select(F.explode(found).alias("anomaly")).select("anomaly.*")


def default_rule_rows() -> list[tuple]:
    """The error rule and the latency rule of :mod:`.rules` as rows of the table ``RULE``."""
    ms = "CAST(durationMs AS BIGINT)"
    as_json = "map('ignoreNullFields', 'false')"
    return [
        (
            "error-rule", "error-rate", "log", "level STRING, message STRING", "level IN ('ERROR', 'FATAL')", "1.0D",
            "'WARNING'", "concat('Error detected: ', coalesce(message, 'null'))",
            f"to_json(named_struct('level', level, 'message', message), {as_json})", None, None,
        ),
        (
            "latency-rule", "latency", "trace", "durationMs DOUBLE, operation STRING", f"{ms} >= 1000", f"{ms} / 1000.0D",
            f"if({ms} > 5000, 'CRITICAL', 'WARNING')",
            f"concat('High latency: ', {ms}, 'ms for ', coalesce(operation, 'null'))",
            f"to_json(named_struct('durationMs', {ms}, 'operation', operation), {as_json})", None, None,
        ),
    ]


def rule_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RULE)

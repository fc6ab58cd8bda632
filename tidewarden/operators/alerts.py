"""Alert lifecycle: creation from insights, status changes, listing, notification.

Alerts are created once per anomaly id. Keeping the first one is an aggregation
with map-side combining, so many redelivered copies of one id never meet in a
single task; neither do many status requests for one alert.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_groups
from ..functions.text import has_text, never_null, stable_id, text_or_null
from ..schemas import ACK, OPEN, RESOLVED, WARNING
from .rollup import effective_limit

ALERT_COLUMNS = [
    "id", "title", "severity", "status", "source", "description", "recommendation",
    "anomaly_id", "detected_at", "resolved_at",
]


def alert_candidates(insights: DataFrame) -> DataFrame:
    """One open alert per insight row, before deduplication."""
    detected = F.col("analyzed_at")
    title = F.format_string(
        "Anomaly %s: %s",
        text_or_null(F.col("anomaly_id")),
        text_or_null(F.col("incident_classification")),
    )
    row_id = stable_id(
        F.lit("alert"),
        F.when(has_text("anomaly_id"), F.col("anomaly_id")).otherwise(
            F.coalesce(F.col("id"), F.lit(""))
        ),
    )
    return insights.select(
        row_id.alias("id"),
        title.alias("title"),
        F.coalesce("severity", F.lit(WARNING)).alias("severity"),
        F.lit(OPEN).alias("status"),
        F.coalesce(F.try_element_at("metadata", F.lit("service")), F.lit("unknown")).alias("source"),
        F.coalesce("interpretation", F.lit("No interpretation")).alias("description"),
        F.coalesce(F.array_join("recommendations", "; "), F.lit("")).alias("recommendation"),
        "anomaly_id",
        detected.alias("detected_at"),
        F.lit(None).cast(insights.schema["analyzed_at"].dataType).alias("resolved_at"),
    )


def first_per_anomaly(candidates: DataFrame) -> DataFrame:
    """Keep the earliest alert per anomaly id; blank ids are never merged.

    Each row with a blank id gets an id of its own, also when one insight came twice: from
    its content and its number among equal rows, so a retry gives the same ids
    however the rows are partitioned.
    """
    identified = has_text("anomaly_id")
    others = [c for c in ALERT_COLUMNS if c != "anomaly_id"]
    order = F.struct("detected_at", "id", "title", "description", "recommendation")
    first = (
        candidates.where(identified)
        .groupBy("anomaly_id")
        .agg(F.min_by(F.struct(*others), order).alias("first"))
        .select("anomaly_id", "first.*")
        .select(*ALERT_COLUMNS)
    )
    equal = candidates.where(~identified).groupBy(*ALERT_COLUMNS).agg(F.count(F.lit(1)).alias("_copies"))
    numbered = equal.withColumn("_number", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    own_id = stable_id(*[F.col(c) for c in ALERT_COLUMNS], F.col("_number"))
    blank = numbered.withColumn("id", own_id)
    return first.unionByName(blank.select(*ALERT_COLUMNS))


def create_alerts(insights: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New alerts only: first per anomaly id, and none where one is stored already."""
    fresh = first_per_anomaly(alert_candidates(insights))
    if existing is None:
        return fresh
    # Blank ids take part under their own alert id, so they do not meet in one task.
    identified = has_text("anomaly_id")
    known = existing.where(identified).select(
        F.lit(True).alias("identified"), F.col("anomaly_id").alias("identity")
    )
    keyed = fresh.withColumns(
        {
            "identified": identified,
            "identity": F.when(identified, F.col("anomaly_id")).otherwise(F.col("id")),
        }
    )
    return keyed.join(known, ["identified", "identity"], "left_anti").select(*ALERT_COLUMNS)


class StatusResult(NamedTuple):
    """``outcomes`` has one row per request and outcome, with the state before it."""

    alerts: DataFrame
    outcomes: DataFrame

    @property
    def accepted(self) -> DataFrame:
        return self.outcomes.where(F.col("outcome") == ACCEPTED)

    @property
    def rejected(self) -> DataFrame:
        return self.outcomes.where(F.col("outcome") == REJECTED)

    @property
    def not_found(self) -> DataFrame:
        return self.outcomes.where(F.col("outcome") == NOT_FOUND)


ACCEPTED, REJECTED, NOT_FOUND = "accepted", "rejected", "not found"


def apply_status_updates(alerts: DataFrame, updates: DataFrame) -> StatusResult:
    """Apply status requests (alert_id, new_status, at) in time order.

    Every upward step of OPEN, ACK, RESOLVED is allowed and nothing else, so the
    state before a request is the highest state requested earlier. The outcome
    of all requests therefore follows from the earliest ACK and the earliest
    RESOLVED per alert: two minima instead of a replay. Equal requests appear
    once with their number of ``copies``; only one copy can be accepted.
    """
    stamp = F.struct("at", "new_status")
    requests = updates.groupBy(
        never_null(F.col("alert_id"), F.lit("")).alias("alert_id"), "new_status", "at"
    ).agg(F.count(F.lit(1)).alias("copies"))
    firsts = requests.groupBy("alert_id").agg(
        F.min(F.when(F.col("new_status") == ACK, stamp)).alias("first_ack"),
        F.min(F.when(F.col("new_status") == RESOLVED, stamp)).alias("first_resolved"),
        F.count(F.lit(1)).alias("requests"),
    )
    state = alerts.select(F.col("id").alias("alert_id"), F.col("status").alias("initial"))
    known = firsts.join(state, "alert_id", "left")

    # An ACK is taken from OPEN before any RESOLVED; a RESOLVED from OPEN or ACK.
    ack_taken = (F.col("initial") == OPEN) & F.col("first_ack").isNotNull() & (
        F.col("first_resolved").isNull() | (F.col("first_ack") < F.col("first_resolved"))
    )
    resolve_taken = F.col("initial").isin(OPEN, ACK) & F.col("first_resolved").isNotNull()
    effects = known.select(
        "alert_id", "initial", "requests",
        F.when(ack_taken, F.col("first_ack")).alias("ack"),
        F.when(resolve_taken, F.col("first_resolved")).alias("resolve"),
    )

    judged = join_groups(requests, effects, ["alert_id"], "requests", ["new_status", "at"])
    taken = F.coalesce(
        (stamp == F.col("ack")) | (stamp == F.col("resolve")), F.lit(False)
    )
    before = (
        F.when(F.col("resolve") < stamp, RESOLVED)
        .when(F.col("ack") < stamp, ACK)
        .otherwise(F.col("initial"))
    )
    outcome = judged.withColumns({"taken": taken, "before": before})
    exists = F.col("initial").isNotNull()
    # Of equal requests the first copy is taken and leaves its own status to the others.
    refused = F.col("copies") - F.when(F.col("taken"), 1).otherwise(0)
    seen = F.when(F.col("taken"), F.col("new_status")).otherwise(F.col("before"))

    def entry(name: str, old_status: Column, copies: Column, applies: Column) -> Column:
        made = F.struct(
            F.lit(name).alias("outcome"), old_status.alias("old_status"), copies.alias("copies")
        )
        return F.when(applies, made)

    entries = F.array_compact(
        F.array(
            entry(ACCEPTED, F.col("before"), F.lit(1).cast("bigint"), exists & F.col("taken")),
            entry(REJECTED, seen, refused, exists & (refused > 0)),
            entry(NOT_FOUND, F.lit(None).cast("string"), F.col("copies"), ~exists),
        )
    )
    outcomes = outcome.select(
        "alert_id", "new_status", "at", F.explode(entries).alias("entry")
    ).select("alert_id", "new_status", "at", "entry.*")

    done = effects.where("initial is not null").select(
        F.col("alert_id").alias("id"), "ack", "resolve"
    )
    updated = (
        alerts.join(done, "id", "left")
        .withColumns(
            {
                "status": F.when(F.col("resolve").isNotNull(), RESOLVED)
                .when(F.col("ack").isNotNull(), ACK)
                .otherwise(F.col("status")),
                "resolved_at": F.coalesce("resolve.at", "resolved_at"),
            }
        )
        .select(*alerts.columns)
    )
    return StatusResult(updated, outcomes)


def _instant(value: str | dt.datetime | Column, like: DataFrame) -> Column:
    kind = like.schema["detected_at"].dataType
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, dt.datetime):
        moment = value
    else:
        moment = dt.datetime.fromisoformat(value)
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast(kind)


def list_alerts(
    alerts: DataFrame,
    status: str | None = None,
    severity: str | None = None,
    since: str | dt.datetime | Column | None = None,
    until: str | dt.datetime | Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Newest alerts first, by the first criterion given; criteria do not combine.

    Order of precedence: status, severity, since with until, since, everything.
    ``until`` alone is ignored. The limit applies to the last three only.
    """
    limited = True
    if status is not None and status.strip():
        alerts, limited = alerts.where(F.col("status") == status), False
    elif severity is not None and severity.strip():
        alerts, limited = alerts.where(F.col("severity") == severity), False
    elif since is not None:
        at = F.col("detected_at")
        chosen = at >= _instant(since, alerts)
        if until is not None:
            chosen = chosen & (at < _instant(until, alerts))
        alerts = alerts.where(chosen)
    ordered = alerts.orderBy(F.desc("detected_at"), "id")
    return ordered.limit(effective_limit(limit)) if limited else ordered


def alerts_of_hour(alerts: DataFrame, hour: str | dt.datetime, limit: int = 200) -> DataFrame:
    """Alerts in the hour that begins at ``hour``."""
    begin = dt.datetime.fromisoformat(hour) if isinstance(hour, str) else hour
    return list_alerts(alerts, since=begin, until=begin + dt.timedelta(hours=1), limit=limit)


def notifications(alerts: DataFrame) -> DataFrame:
    """Message for connected viewers: seven fields."""
    return alerts.select(
        F.lit("NEW_ALERT").alias("type"),
        "id", "title", "severity", "status", "source",
        F.col("detected_at").alias("detectedAt"),
    )


def broadcast_notices(alerts: DataFrame) -> DataFrame:
    """Message for the broadcast topic: four fields."""
    return alerts.select("id", "severity", "source", F.col("detected_at").alias("detectedAt"))

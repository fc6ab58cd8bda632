"""The status machine of alerts as keyed state: a few bytes per alert, no table is read per batch.

Alerts and requests are one stream keyed by alert id. A request is judged against the
state that the alert has when it arrives; requests of one micro-batch are taken in the
order of their time. The state is the status and the time of resolution, kept by the RocksDB state store, so
a restarted query goes on where it stopped. Ids are dealt by hash to ``DESKS`` groups of the stream, as every call of a
group costs milliseconds, and the alerts of a group to ``DRAWERS`` values of state, as every value costs a call. A
micro-batch reads and writes the values that its ids fall into and no others.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.alerts import ACCEPTED, NOT_FOUND, REJECTED
from ..schemas import ACK, OPEN, RESOLVED
from .streams import append_writer, use_rocksdb

#: A request is accepted if it goes up.
_RANK = {OPEN: 0, ACK: 1, RESOLVED: 2}
#: Both numbers are part of the state: a checkpoint goes with the numbers it was begun with.
DESKS, DRAWERS = 1024, 64
#: Judged requests handed on at once.
ROWS = 10_000
_DRAWER = T.StructType([T.StructField("drawer", T.IntegerType())])
_HELD = T.StructType([T.StructField("alerts", T.StringType())])
_JUDGED = T.StructType([
    T.StructField("alert_id", T.StringType()), T.StructField("new_status", T.StringType()), T.StructField("at", T.LongType()),
    T.StructField("old_status", T.StringType()), T.StructField("outcome", T.StringType()), T.StructField("copies", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("resolved_at", T.LongType()),
])


def _judge(alert_id: str, held: dict[str, list], created: tuple | None, asked: dict[tuple, int]) -> Iterator[tuple]:
    """The judged requests for one alert; ``held`` (id to status and time of resolution) goes along."""
    if alert_id not in held and created is not None:
        held[alert_id] = [created[2] if created[1] else None, None]
    known = alert_id in held
    status, resolved_at = held[alert_id] if known else (None, None)
    order = sorted(asked, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for at, wanted in order:
        copies = asked[at, wanted]
        if not known:
            yield alert_id, wanted, at, None, NOT_FOUND, copies, None, None
            continue
        if _RANK.get(wanted, -1) > _RANK.get(status, 9):
            before, status = status, wanted
            resolved_at = at if wanted == RESOLVED else resolved_at
            held[alert_id] = [status, resolved_at]
            yield alert_id, wanted, at, before, ACCEPTED, 1, status, resolved_at
            copies -= 1
        if copies:
            yield alert_id, wanted, at, status, REJECTED, copies, status, resolved_at


def _framed(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_JUDGED.names).astype({n: "Int64" for n in ("at", "copies", "resolved_at")})


class _Desk(StatefulProcessor):
    """Judges the requests for a group of alerts. Times are microseconds; a batch's requests for one alert are held as counts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._drawers = handle.getMapState("drawers", _DRAWER, _HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        created: dict[int, dict[str, tuple]] = {}
        asked: dict[int, dict[str, dict[tuple, int]]] = {}
        for part in rows:
            columns = (part[c].tolist() for c in ("drawer", "alert_id", "kind", "status", "at"))
            for drawer, alert_id, kind, status, at in zip(*columns, strict=True):
                status, at = None if pd.isna(status) else status, None if pd.isna(at) else int(at)
                if kind == 0:
                    made, first = (at or 0, status is not None, status or ""), created.setdefault(drawer, {})
                    first[alert_id] = min(first.get(alert_id, made), made)
                else:
                    of_alert = asked.setdefault(drawer, {}).setdefault(alert_id, {})
                    of_alert[at, status] = of_alert.get((at, status), 0) + 1
        out: list[tuple] = []
        for drawer in sorted(created.keys() | asked.keys()):
            before = self._drawers.getValue((drawer,))[0] if self._drawers.containsKey((drawer,)) else "{}"
            held = json.loads(before)
            made, wanted = created.get(drawer, {}), asked.get(drawer, {})
            for alert_id in sorted(made.keys() | wanted.keys()):
                out.extend(_judge(alert_id, held, made.get(alert_id), wanted.get(alert_id, {})))
            after = json.dumps(held, separators=(",", ":"))
            if after != before:
                self._drawers.updateValue((drawer,), (after,))
            if len(out) >= ROWS:
                yield _framed(out)
                out = []
        if out:
            yield _framed(out)

    def close(self) -> None:
        pass


def judged_requests(alerts: DataFrame, updates: DataFrame) -> DataFrame:
    """One row per request and outcome (append mode), like ``alerts.apply_status_updates`` gives in batches,
    with the alert's ``status`` and ``resolved_at`` after it.

    ``alerts`` and ``updates`` are streams. An alert counts from the micro-batch that brings it on; a request
    for an alert nobody has yet is not found. An alert that comes again changes nothing. State grows by one
    entry per alert.
    """
    use_rocksdb(alerts.sparkSession)
    rows = alerts.select(
        F.coalesce("id", F.lit("")).alias("alert_id"), F.lit(0).alias("kind"), "status", F.unix_micros("detected_at").alias("at")
    ).unionByName(
        updates.select(
            F.coalesce("alert_id", F.lit("")).alias("alert_id"), F.lit(1).alias("kind"),
            F.col("new_status").alias("status"), F.unix_micros("at").alias("at"),
        )
    )
    place = F.pmod(F.xxhash64("alert_id"), F.lit(DESKS * DRAWERS))
    dealt = rows.withColumns({"desk": (place % DESKS).cast("int"), "drawer": F.floor(place / DESKS).cast("int")})
    judged = dealt.groupBy("desk").transformWithStateInPandas(
        statefulProcessor=_Desk(), outputStructType=_JUDGED, outputMode="Append", timeMode="None"
    )
    return judged.withColumns({"at": F.timestamp_micros("at"), "resolved_at": F.timestamp_micros("resolved_at")})


def status_state_stream(
    alerts: DataFrame, updates: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "5 seconds"
) -> StreamingQuery:
    """Write the judged requests; the sink records complete batches only."""
    return append_writer(judged_requests(alerts, updates), path, checkpoint, available_now, every).start()


def with_status(alerts: DataFrame, judged: DataFrame) -> DataFrame:
    """Alerts in the state that the judged requests have led to.

    Steps only go up, so the last one is the highest: two plain maxima per alert.
    """
    taken = judged.where(F.col("outcome") == ACCEPTED).groupBy(F.col("alert_id").alias("id")).agg(
        F.max(F.when(F.col("status") == RESOLVED, 2).when(F.col("status") == ACK, 1).otherwise(0)).alias("_rank"),
        F.max("resolved_at").alias("_resolved_at"),
    )
    status = F.when(F.col("_rank") == 2, RESOLVED).when(F.col("_rank") == 1, ACK).otherwise(F.col("status"))
    joined = alerts.join(taken, "id", "left").withColumns(
        {"status": status, "resolved_at": F.coalesce("_resolved_at", "resolved_at")}
    )
    return joined.select(*alerts.columns)

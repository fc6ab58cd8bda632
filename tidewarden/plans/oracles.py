"""Independent SQL for the registered queries, written against the raw tables.

The SQL never sees the JSON payloads or the operators: it restates each result
from the columns of the supplied tables.
"""

from __future__ import annotations

from ..operators.insights import (
    ANOMALY_PROMPT,
    FALLBACK_CAUSES,
    FALLBACK_INTERPRETATION,
    FALLBACK_RECOMMENDATIONS,
    LOG_PROMPT,
    NULL_CAUSES,
    NULL_INTERPRETATION,
)
from .registry import ALERT_SERVICES, INGEST_AS_OF, STATS_AS_OF, STORE_AS_OF


def _tel(services: int = 2) -> str:
    return f"""tel AS (
      SELECT 'evt-' || event_id AS id, 'svc-' || (user_id % {services}) AS source,
             CASE WHEN event_type = 'error' THEN 'log' WHEN event_type = 'purchase' THEN 'trace'
                  ELSE 'metric' END AS type,
             event_type AS subtype, value, ts, user_id, props,
             CAST(json_extract(props, '$.k') AS BIGINT) AS k,
             CASE WHEN user_id % 3 <> 0 THEN 'user-' || user_id END AS correlation_id
      FROM events)"""


def _id(*parts: str) -> str:
    return f"substr(sha256(CAST(to_json([{', '.join(parts)}]) AS VARCHAR)), 1, 32)"


def _bucket(bucket: str) -> str:
    origin = "2000-01-01" if "month" in bucket else "2000-01-03"
    return f"time_bucket(INTERVAL '{bucket}', ts, TIMESTAMP '{origin} 00:00:00')"


def _scored(bucket: str, correlated: bool) -> str:
    """CTE ``hits``: z-score hits with their group statistics."""
    extra = "AND correlation_id IS NOT NULL" if correlated else ""
    detector = "enriched-zscore" if correlated else "raw-zscore"
    anomaly = _id(f"'{detector}'", "CAST(w AS VARCHAR)", "source", "subtype", "id", "NULL")
    return f"""samples AS (
      SELECT *, {_bucket(bucket)} AS w FROM tel WHERE type = 'metric' {extra}),
    stats AS (
      SELECT w, source, subtype, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS sd
      FROM samples GROUP BY ALL),
    hits AS (
      SELECT {anomaly} AS id, source AS service, subtype AS metric,
             abs((value - mean) / sd) AS z, w, w + INTERVAL '{bucket}' AS w_end, correlation_id,
             '{detector}' AS detector, id AS event_id, value, mean, sd, n
      FROM samples JOIN stats USING (w, source, subtype)
      WHERE n >= 5 AND sd >= 0.001 AND abs((value - mean) / sd) > 3.0)"""


def _zscore(bucket: str, correlated: bool = False) -> str:
    return f"""WITH {_tel()}, {_scored(bucket, correlated)}
    SELECT id, service, metric, round(z + 1e-9, 6) AS score,
           CASE WHEN z > 5.0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
           w_end AS detected_at, correlation_id, detector, event_id
    FROM hits"""


_DURATION = "CAST(floor(value * 20) AS BIGINT)"
_LEVEL = "CASE k % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'FATAL' ELSE 'WARN' END"


def _rules(services: int = 2) -> str:
    """CTE ``ruled``: error and latency anomalies."""
    error_id = _id("'error-rule'", "source", "'error-rate'", "id", "NULL")
    latency_id = _id("'latency-rule'", "source", "'latency'", "id", "NULL")
    return f"""{_tel(services)},
    ruled AS (
      SELECT {error_id} AS id, source AS service, 'error-rate' AS metric, 1.0::DOUBLE AS score,
             'WARNING' AS severity, 'Error detected: ' || props AS description,
             ts AS detected_at, correlation_id, 'error-rule' AS detector, id AS event_id,
             {_LEVEL} AS level, props AS message, NULL::BIGINT AS duration_ms, k
      FROM tel WHERE type = 'log' AND k % 3 <> 2
      UNION ALL
      SELECT {latency_id}, source, 'latency', {_DURATION} / 1000.0::DOUBLE,
             CASE WHEN {_DURATION} > 5000 THEN 'CRITICAL' ELSE 'WARNING' END,
             'High latency: ' || {_DURATION} || 'ms for purchase',
             ts, correlation_id, 'latency-rule', id, NULL, NULL, {_DURATION}, k
      FROM tel WHERE type = 'trace' AND {_DURATION} >= 1000)"""


def _filled(template: str, parts: list[str]) -> str:
    """SQL concatenation that fills the placeholders of a prompt template."""
    pieces = template.replace("%.2f", "%s").split("%s")
    sql = ["'" + pieces[0].replace("'", "''") + "'"]
    for part, piece in zip(parts, pieces[1:], strict=True):
        sql += [part, "'" + piece.replace("'", "''") + "'"]
    return " || ".join(sql)


# Half-up at two decimals, on whole milliseconds.
_CENTS = "CASE WHEN duration_ms IS NULL THEN 100 ELSE (duration_ms + 5) // 10 END"
_SCORE_TEXT = f"(({_CENTS}) // 100) || '.' || lpad(CAST(({_CENTS}) % 100 AS VARCHAR), 2, '0')"

_KIND = "CASE metric WHEN 'latency' THEN 'LatencyIssue' ELSE 'ErrorSpike' END"
_SAYS = "metric || ' on ' || service || ' is outside its usual range'"
_CAUSES = "'change of load on ' || service || '|fault in ' || service"
_ADVICE = "'inspect ' || metric || ' on ' || service"


def _insights(varied: bool) -> str:
    turn = "ascii(id) % 6" if varied else "5"
    broken = f"{turn} IN (1, 2, 3, 4)"
    return f"""WITH {_rules(ALERT_SERVICES)}
    SELECT {_id("'insight'", "id")} AS id, id AS anomaly_id, severity, round(score + 1e-9, 6) AS score,
      CASE WHEN {broken} THEN '{FALLBACK_INTERPRETATION}'
           WHEN {turn} = 0 THEN '{NULL_INTERPRETATION}' ELSE {_SAYS} END AS interpretation,
      CASE WHEN {broken} THEN 'Unknown' WHEN {turn} = 0 THEN 'Spiky' ELSE {_KIND} END
        AS incident_classification,
      CASE WHEN {broken} THEN '{FALLBACK_CAUSES[0]}' WHEN {turn} = 0 THEN '{NULL_CAUSES[0]}'
           ELSE {_CAUSES} END AS causes,
      CASE WHEN {broken} THEN '{FALLBACK_RECOMMENDATIONS[0]}' WHEN {turn} = 0 THEN 'look'
           ELSE {_ADVICE} END AS advice,
      NOT ({broken}) AS has_raw, service, metric
    FROM ruled"""


def _alerts() -> str:
    """CTE ``alerts``: the alert table of the registry."""
    status = "CASE ascii(id) % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'ACK' ELSE 'RESOLVED' END"
    return f"""{_rules(ALERT_SERVICES)},
    made AS (
      SELECT {_id("'alert'", "id")} AS id, 'Anomaly ' || id || ': ' || {_KIND} AS title,
             severity, service AS source, {_SAYS} AS description, {_ADVICE} AS recommendation,
             id AS anomaly_id, detected_at
      FROM ruled),
    alerts AS (
      SELECT *, {status} AS status,
             CASE WHEN {status} = 'RESOLVED' THEN detected_at + INTERVAL 1 HOUR END AS resolved_at
      FROM made)"""


_LISTED = "SELECT id, severity, status, source, detected_at FROM alerts"
_NEWEST = "ORDER BY detected_at DESC, id"
_NOW = f"TIMESTAMP '{STATS_AS_OF}'"
_HOURLY = f"""hours AS (
      SELECT date_trunc('hour', detected_at) AS hour, count(*) AS count FROM alerts
      WHERE detected_at >= {_NOW} - INTERVAL 1 DAY GROUP BY ALL)"""


def _alert_query(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([_alerts(), *ctes])} {body}"


def _rollup(bucket: str) -> str:
    return f"""WITH {_tel()}
    SELECT {_bucket(bucket)} AS bucket, source AS service, subtype AS metric_name,
           round(avg(value) + 1e-9, 6) AS avg, min(value) AS min, max(value) AS max,
           round(quantile_cont(value, 0.95) + 1e-9, 6) AS p95, round(quantile_cont(value, 0.99) + 1e-9, 6) AS p99,
           count(*) AS cnt
    FROM tel WHERE type = 'metric' GROUP BY ALL"""


_CORRELATED = f"""{_tel()},
    grouped AS (SELECT *, {_bucket('1 day')} AS w FROM tel WHERE correlation_id IS NOT NULL)"""

_CORRELATE = f"""WITH {_CORRELATED},
    groups AS (
      SELECT w, correlation_id, count(*) AS n, count(DISTINCT source) AS kinds
      FROM grouped GROUP BY ALL)
    SELECT id, correlation_id, w AS window_start, w + INTERVAL 1 DAY AS window_end,
           n AS correlated_count, CAST(kinds AS INTEGER) AS unique_services
    FROM grouped JOIN groups USING (w, correlation_id)"""

# CTE ``context``: distinct member ids behind each firing metric group.
_CONTEXT = f"""{_scored('1 day', True)},
    grouped AS (SELECT *, {_bucket('1 day')} AS w FROM tel WHERE correlation_id IS NOT NULL),
    firing AS (SELECT DISTINCT w, service AS source, metric FROM hits),
    touched AS (
      SELECT DISTINCT w, s.source, s.subtype AS metric, s.correlation_id
      FROM samples s JOIN firing f USING (w) WHERE s.source = f.source AND s.subtype = f.metric),
    context AS (
      SELECT DISTINCT t.w, t.source, t.metric, g.id, g.source AS member_source
      FROM touched t JOIN grouped g ON g.w = t.w AND g.correlation_id = t.correlation_id)"""

_REQUEST_TS = f"CASE WHEN k % 10 <> 0 THEN ts ELSE TIMESTAMP '{INGEST_AS_OF}' END"
_REQUESTS = """req AS (
      SELECT *, 'req-' || event_id AS id, 'svc-' || (user_id % 2) AS svc,
             CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""


def _decimal(column: str, digits: int) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(38, 15)), {digits}) AS VARCHAR)"


_TURN = "ascii(substr(id, 2, 1)) % 4"
_STATUS_STEPS = f"""asked AS (
      SELECT *, CASE {_TURN} WHEN 0 THEN 'ACK' WHEN 1 THEN 'RESOLVED' WHEN 2 THEN 'OPEN'
                     ELSE 'ACK' END AS ask1,
             CASE {_TURN} WHEN 3 THEN 'ACK' ELSE 'RESOLVED' END AS ask2,
             detected_at + INTERVAL 1 HOUR AS at1, detected_at + INTERVAL 2 HOUR AS at2
      FROM alerts),
    step1 AS (
      SELECT *, (status, ask1) IN (('OPEN', 'ACK'), ('OPEN', 'RESOLVED'), ('ACK', 'RESOLVED')) AS ok1
      FROM asked),
    step2 AS (
      SELECT *, CASE WHEN ok1 THEN ask1 ELSE status END AS status1 FROM step1),
    steps AS (
      SELECT *, (status1, ask2) IN (('OPEN', 'ACK'), ('OPEN', 'RESOLVED'), ('ACK', 'RESOLVED')) AS ok2
      FROM step2)"""


def oracle_sql() -> dict[str, str]:
    enriched = f"""WITH {_tel()}, {_CONTEXT},
        sums AS (SELECT w, source, metric, count(DISTINCT id) AS ids,
                        count(DISTINCT member_source) AS services
                 FROM context GROUP BY ALL)
        SELECT h.id, h.service, h.metric, round(z + 1e-9, 6) AS score,
               CASE WHEN z > 5.0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
               h.correlation_id, h.event_id, h.n AS window_size, s.ids AS correlated_count,
               s.services AS unique_services, round(z + 1e-9, 6) AS z_score
        FROM hits h JOIN sums s ON h.w = s.w AND h.service = s.source AND h.metric = s.metric"""
    z = {
        "raw_zscore_daily": _zscore("1 day"),
        "raw_zscore_weekly": _zscore("7 days"),
        "raw_zscore_two_step": _zscore("1 day"),
        "raw_zscore_exact": _zscore("1 day"),
        "stream_raw_zscore": _zscore("1 day"),
        "stream_enriched_zscore": enriched,
        "window_statistics_daily": f"""WITH {_tel()}, {_scored('1 day', False)}
            SELECT w AS window_start, source, subtype AS metric, n AS events, n AS samples,
                   round(mean + 1e-9, 6) AS mean, round(sd + 1e-9, 6) AS stddev FROM stats""",
        "enriched_zscore_daily": enriched,
        "enriched_context_links": f"""WITH {_tel()}, {_CONTEXT}
            SELECT w AS window_start, source, metric, correlation_id FROM touched""",
        "enriched_context_services": f"""WITH {_tel()}, {_CONTEXT}
            SELECT DISTINCT w AS window_start, source, metric, member_source AS service FROM context""",
        "planted_infinity_zscore": f"""SELECT z.* FROM ({_zscore('1 day')}) z ANTI JOIN (
              SELECT DISTINCT 'svc-' || (user_id % 2) AS service, event_type AS metric,
                     date_trunc('day', ts) + INTERVAL 1 DAY AS detected_at
              FROM events WHERE event_id % 101 = 0) p USING (service, metric, detected_at)""",
        "planted_huge_latency": f"""WITH {_rules()},
            huge AS (SELECT 'evt-' || event_id AS event_id, 'svc-' || (user_id % 2) AS source
                     FROM events WHERE event_type = 'purchase' AND event_id % 7 = 0)
            SELECT id, severity, duration_ms FROM ruled
            WHERE metric = 'latency' AND event_id NOT IN (SELECT event_id FROM huge)
            UNION ALL
            SELECT {_id("'latency-rule'", "source", "'latency'", "event_id", "NULL")}, 'CRITICAL',
                   9223372036854775807 FROM huge""",
        "planted_infinity_rollup": f"""WITH {_tel()},
            planted AS (SELECT *, CASE WHEN CAST(substr(id, 5) AS BIGINT) % 101 = 0
                               THEN CAST('inf' AS DOUBLE) ELSE value END AS v FROM tel)
            SELECT {_bucket('1 day')} AS bucket, source AS service, subtype AS metric_name,
                   min(v) AS min, max(v) AS max, count(*) AS cnt
            FROM planted WHERE type = 'metric' GROUP BY ALL""",
        "correlation_services_daily": f"""WITH {_tel(7)}
            SELECT {_bucket('1 day')} AS window_start, correlation_id, source AS service,
                   count(*) AS events FROM tel WHERE correlation_id IS NOT NULL GROUP BY ALL""",
        "correlation_chunks_daily": f"""WITH {_CORRELATED}
            SELECT w AS window_start, correlation_id, id AS member_id, count(*) AS copies
            FROM grouped GROUP BY ALL""",
        "correlation_chunks_ordered": f"""WITH {_tel()},
            placed AS (SELECT {_bucket('7 days')} AS window_start, correlation_id, id, ts,
                              row_number() OVER (PARTITION BY {_bucket('7 days')}, correlation_id ORDER BY ts, id) - 1 AS p
                       FROM tel WHERE correlation_id IS NOT NULL)
            SELECT window_start, correlation_id, p // 4 AS chunk, array_to_string(list(id ORDER BY ts, id), ',') AS members
            FROM placed GROUP BY ALL""",
        "context_id_chunks": f"""WITH {_tel()}, {_CONTEXT},
            ids AS (SELECT DISTINCT w, source, metric, id FROM context),
            placed AS (SELECT *, row_number() OVER (PARTITION BY w, source, metric ORDER BY id) - 1 AS p FROM ids)
            SELECT w AS window_start, source, metric, p // 10 AS chunk, array_to_string(list(id ORDER BY id), ',') AS ids
            FROM placed GROUP BY ALL""",
        "split_request_arrays": """
            SELECT 'svc-' || (user_id % 2) AS source, event_type AS type, props AS payload,
                   'evt-' || event_id AS correlation_id, value FROM events""",
        "batch_receipt_ids": """
            SELECT user_id AS batch_id, 'evt-' || event_id AS id, count(*) AS copies
            FROM events GROUP BY ALL""",
        "wire_enriched_roundtrip": f"""SELECT id, source, window_start,
              correlated_count, unique_services FROM ({_CORRELATE})
              JOIN (SELECT 'evt-' || event_id AS id, 'svc-' || (user_id % 2) AS source FROM events)
              USING (id)""",
        "wire_anomaly_roundtrip": f"""WITH {_rules(ALERT_SERVICES)}
            SELECT id, service, metric, round(score + 1e-9, 6) AS score, severity, detected_at, correlation_id FROM ruled""",
        "wire_insight_roundtrip": f"""SELECT id, anomaly_id, severity, score,
              incident_classification FROM ({_insights(varied=False)})""",
        "store_roundtrip": f"""WITH {_tel()}
            SELECT id, source, type, subtype, ts, correlation_id FROM tel""",
        "store_redelivery": f"""WITH {_tel()}
            SELECT id, CASE WHEN k % 2 = 0 THEN subtype || '-again' ELSE subtype END AS subtype FROM tel""",
        "store_compacted": f"""WITH {_tel()}
            SELECT id, source, type, subtype, ts, correlation_id,
                   CASE WHEN type = 'metric' THEN subtype END AS metric_name,
                   CASE WHEN type = 'metric' THEN value END AS value FROM tel""",
        "store_points": f"""WITH {_tel()}
            SELECT ts AS time, id || '-m' AS id, source AS service, subtype AS metric_name, value
            FROM tel WHERE type = 'metric'""",
        "anomaly_defaults": f"""WITH {_rules(ALERT_SERVICES)}
            SELECT id, CASE WHEN ascii(id) % 2 = 0 THEN 'WARNING' ELSE severity END AS severity,
                   CASE WHEN ascii(id) % 3 = 0 THEN TIMESTAMP '{STATS_AS_OF}' ELSE detected_at END AS detected_at
            FROM ruled""",
        "sensor_files": """
            SELECT 'termo-sensor' AS source, 'temperature' AS subtype, date_trunc('second', ts) AS ts,
                   event_id AS packet_id, value AS reading, CAST(user_id AS VARCHAR) AS sensor FROM events
            UNION ALL
            SELECT 'fuel-sensor', 'fuel-level', date_trunc('second', ts), event_id, value / 2,
                   CAST(user_id AS VARCHAR) FROM events""",
        "wire_message_keys": f"""
            SELECT 'event' AS kind, source || ':' || type AS key, id FROM (WITH {_tel()} SELECT * FROM tel)
            UNION ALL
            SELECT 'anomaly', service || ':' || metric, id FROM (WITH {_rules(ALERT_SERVICES)} SELECT * FROM ruled)
            UNION ALL SELECT 'insight', anomaly_id, id FROM ({_insights(varied=False)})""",
        "insight_scorer_failures": f"""WITH {_rules(ALERT_SERVICES)}
            SELECT id AS anomaly_id,
                   CASE severity WHEN 'CRITICAL' THEN '{FALLBACK_INTERPRETATION}' ELSE 'fine' END AS interpretation,
                   CASE severity WHEN 'CRITICAL' THEN 'Unknown' ELSE 'Other' END AS incident_classification
            FROM ruled""",
        "alerts_from_all_detectors": f"""
            WITH found AS (
              SELECT id, service, severity, detected_at FROM ({_zscore('1 day')}) UNION ALL
              SELECT id, service, severity, detected_at FROM ({_zscore('1 day', correlated=True)}) UNION ALL
              SELECT * FROM (WITH {_rules()} SELECT id, service, severity, detected_at FROM ruled))
            SELECT {_id("'alert'", "id")} AS id, severity, 'OPEN' AS status, service AS source,
                   id AS anomaly_id, detected_at FROM found""",
        "rule_error": f"""WITH {_rules()}
            SELECT id, service, metric, score, severity, description, detected_at, correlation_id,
                   level, message FROM ruled WHERE metric = 'error-rate'""",
        "rule_latency": f"""WITH {_rules()}
            SELECT id, service, metric, round(score + 1e-9, 6) AS score, severity, description,
                   detected_at, correlation_id, duration_ms, 'purchase' AS operation
            FROM ruled WHERE metric = 'latency'""",
        "rule_table": f"""WITH {_rules()}
            SELECT id, service, metric, round(score + 1e-9, 6) AS score, severity, description, detected_at,
                   correlation_id, detector, event_id FROM ruled""",
        "rule_versions": f"""WITH {_rules()}
            SELECT service, metric, round(score + 1e-9, 6) AS score,
                   CASE WHEN detected_at < TIMESTAMP '2024-01-15' THEN severity
                        WHEN duration_ms > 1800 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
                   description, detector, event_id
            FROM ruled WHERE metric = 'latency'
              AND (detected_at < TIMESTAMP '2024-01-15' OR duration_ms >= 1500)
            UNION ALL
            SELECT source, 'load', round(value + 1e-9, 6), CASE WHEN value > 99 THEN 'CRITICAL' ELSE 'WARNING' END,
                   subtype || ' ' || id, 'busy', id
            FROM tel WHERE type = 'metric' AND value > 90 AND source = 'svc-1' AND k = 3""",
        "anomaly_union": f"""
            SELECT * FROM ({_zscore('1 day')}) UNION ALL
            SELECT * FROM ({_zscore('1 day', correlated=True)}) UNION ALL
            SELECT * FROM (WITH {_rules()}
              SELECT id, service, metric, round(score + 1e-9, 6) AS score, severity, detected_at,
                     correlation_id, detector, event_id FROM ruled)""",
        "anomaly_description": f"""WITH {_tel()}, {_scored('1 day', False)}
            SELECT id, 'Z-score ' || {_decimal('z', 2)} || ' for ' || metric || ' (value=' ||
                   {_decimal('value', 1)} || ', mean=' || {_decimal('mean', 1)} || ', stddev=' ||
                   {_decimal('sd', 1)} || ')' AS description,
                   value, round(mean + 1e-9, 6) AS mean, round(sd + 1e-9, 6) AS stddev, n AS window_size
            FROM hits""",
        "correlate_daily": _CORRELATE,
        "stream_correlate": _CORRELATE,
        "correlation_groups_daily": f"""WITH {_tel(7)},
            grouped AS (SELECT *, {_bucket('1 day')} AS w FROM tel WHERE correlation_id IS NOT NULL)
            SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, correlation_id,
                   count(*) AS correlated_count,
                   CAST(count(DISTINCT source) AS INTEGER) AS unique_services
            FROM grouped GROUP BY w, correlation_id""",
        "correlation_members_daily": f"""WITH {_CORRELATED}
            SELECT w AS window_start, correlation_id, id AS member_id, count(*) AS copies,
                   min(ts) AS first_ts FROM grouped GROUP BY ALL""",
        "metric_points": f"""WITH {_tel()}
            SELECT ts AS time, id || '-m' AS id, source AS service, subtype AS metric_name, value,
                   CAST(k AS VARCHAR) AS tag_k FROM tel WHERE type = 'metric'""",
        "metric_rollup_hourly": _rollup("1 hour"),
        "metric_rollup_daily": _rollup("1 day"),
        "metric_rollup_weekly": _rollup("7 days"),
        "rollup_from_minutes": f"""SELECT bucket, service, metric_name, avg, min, max, cnt,
                   true AS p95_near, true AS p99_near FROM ({_rollup('7 days')})""",
        "metric_rollup_monthly": _rollup("1 month"),
        "metric_rollup_large_groups": _rollup("7 days"),
        "metric_rollup_orders": """
            SELECT date_trunc('month', CAST(l_shipdate AS TIMESTAMP))::TIMESTAMP AS bucket,
                   l_returnflag AS service, l_linestatus AS metric_name,
                   round(avg(l_extendedprice::DOUBLE) + 1e-9, 6) AS avg,
                   min(l_extendedprice::DOUBLE) AS min, max(l_extendedprice::DOUBLE) AS max,
                   round(quantile_cont(l_extendedprice::DOUBLE, 0.95) + 1e-9, 6) AS p95,
                   round(quantile_cont(l_extendedprice::DOUBLE, 0.99) + 1e-9, 6) AS p99, count(*) AS cnt
            FROM lineitem GROUP BY ALL""",
        "metric_rollup_latest": f"""SELECT * FROM (
            {_rollup('1 hour').replace("WHERE type = 'metric'", '''WHERE type = 'metric'
              AND source = 'svc-1' AND ts BETWEEN TIMESTAMP '2024-01-02 00:00:00'
              AND TIMESTAMP '2024-01-20 00:00:00' ''')})
            ORDER BY bucket DESC, service, metric_name LIMIT 50""",
        "event_search": f"""WITH {_tel()}
            SELECT id, source, type, subtype, ts, correlation_id FROM tel
            WHERE type = 'log' AND k % 3 = 0 AND CAST(k AS VARCHAR) LIKE '1%'
              AND ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'
            ORDER BY ts DESC, id LIMIT 100""",
        "event_matches": f"""WITH {_tel()}
            SELECT id, source, type, ts FROM tel
            WHERE source = 'svc-0' AND k BETWEEN 70 AND 79""",
        "indexed_search": f"""WITH {_tel()}
            SELECT id, source, type, ts FROM tel
            WHERE source = 'svc-0' AND k BETWEEN 70 AND 79""",
        "conversation_search": """
            SELECT concat_ws('-', 'turn', conv_id, turn) AS id, role AS source
            FROM conversations WHERE text LIKE '%the%a%'""",
        "storage_summary": f"""WITH {_tel()}
            SELECT count(*) AS total_events, count(*) FILTER (type = 'metric') AS total_metrics,
                   count(*) FILTER (recent) AS events_last_hour,
                   count(*) FILTER (recent AND type = 'metric') AS metrics_last_hour
            FROM (SELECT *, ts >= TIMESTAMP '{STORE_AS_OF}' - INTERVAL 1 HOUR AS recent FROM tel)""",
        "latest_event": f"""WITH {_tel()},
            both_writes AS (
              SELECT id, subtype, ts AS received_at FROM tel UNION ALL
              SELECT id, subtype || '-again',
                     CASE WHEN k % 2 = 0 THEN ts + INTERVAL 1 HOUR ELSE ts - INTERVAL 1 HOUR END
              FROM tel)
            SELECT id, subtype, received_at FROM both_writes
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY received_at DESC) = 1""",
        "normalize_event": f"""WITH {_REQUESTS}
            SELECT id, svc AS source, 'metric' AS type, event_type AS subtype, {_REQUEST_TS} AS ts,
                   'user-' || user_id AS correlation_id,
                   CASE WHEN user_id % 2 = 0 THEN props ELSE '{{}}' END AS payload
            FROM req WHERE k % 10 NOT IN (6, 7)""",
        "normalize_log": f"""WITH {_REQUESTS}
            SELECT id, svc AS source, 'log' AS type, lower({_LEVEL}) AS subtype, {_REQUEST_TS} AS ts,
                   'user-' || user_id AS correlation_id, {_LEVEL} AS level, props AS message
            FROM req WHERE k % 10 <> 3""",
        "normalize_metric": f"""WITH {_REQUESTS}
            SELECT id, svc AS source, 'metric' AS type, event_type AS subtype, {_REQUEST_TS} AS ts,
                   NULL::VARCHAR AS correlation_id, event_type AS metric, value
            FROM req WHERE k % 10 NOT IN (4, 5)""",
        "normalize_trace": f"""WITH {_REQUESTS}
            SELECT id, svc AS source, 'trace' AS type, event_type AS subtype, {_REQUEST_TS} AS ts,
                   'trace-' || user_id AS correlation_id, 'trace-' || user_id AS "traceId",
                   'span-' || event_id AS "spanId",
                   CASE WHEN user_id % 2 = 0 THEN 'root' ELSE '' END AS "parentSpanId",
                   event_type AS operation, {_DURATION} AS "durationMs",
                   strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "startTime"
            FROM req""",
        "validate_split": f"""WITH {_REQUESTS}
            SELECT 'metric' AS kind, id,
                   CASE k % 10 WHEN 4 THEN 'source is blank' ELSE 'value is missing' END AS reasons
            FROM req WHERE k % 10 IN (4, 5)
            UNION ALL SELECT 'log', id, 'message is blank' FROM req WHERE k % 10 = 3""",
        "batch_receipt": """
            SELECT user_id AS batch_id, count(*) AS count FROM events GROUP BY user_id""",
        "wire_json_roundtrip": f"""WITH {_tel()}
            SELECT CASE WHEN type = 'metric' THEN value END AS value,
                   CASE WHEN type = 'trace' THEN CAST(floor(value * 20) AS BIGINT) END AS duration_ms,
                   CASE WHEN type = 'log' THEN CASE k % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'FATAL'
                     ELSE 'WARN' END END AS level,
                   id, source, type, subtype, ts, correlation_id, CAST(k AS VARCHAR) AS tag_k
            FROM tel""",
        "wire_rejects": f"""WITH {_tel()}
            SELECT CASE k % 4 WHEN 0 THEN 'malformed JSON' ELSE 'event' END AS outcome,
                   count(*) AS messages
            FROM tel WHERE k % 4 <> 1 GROUP BY ALL""",
        "prompt_text": f"""WITH {_rules(ALERT_SERVICES)}
            SELECT id, {_filled(ANOMALY_PROMPT, ["'German'", 'service', 'metric', 'severity',
                   _SCORE_TEXT, 'description', "'none'", "'German'", "'German'", "'German'"])} AS prompt
            FROM ruled""",
        "log_prompt_text": f"""WITH {_tel()}
            SELECT id, {_filled(LOG_PROMPT, ["'xx'", 'source', _LEVEL, 'props', "'xx'", "'xx'"])}
                   AS prompt FROM tel WHERE type = 'log'""",
        "insight_parse": _insights(varied=False),
        "insight_fallback": _insights(varied=True),
    }
    open_text = "string_agg(severity || '=' || n, ',' ORDER BY severity)"
    return z | {
        "alerts_from_insights": _alert_query(
            """SELECT id, title, severity, 'OPEN' AS status, source, description, recommendation,
                      anomaly_id, detected_at FROM alerts WHERE severity <> 'CRITICAL'"""
        ),
        "alert_notifications": _alert_query(
            """SELECT 'NEW_ALERT' AS type, id, title, severity, status, source, detected_at
               FROM alerts"""
        ),
        "wire_notices": _alert_query(
            """SELECT id AS key, id, severity, source,
                      strftime(detected_at, '%Y-%m-%dT%H:%M:%S') ||
                      CASE WHEN us = 0 THEN '' WHEN us % 1000 = 0 THEN '.' || lpad(CAST(us // 1000 AS VARCHAR), 3, '0')
                           ELSE '.' || lpad(CAST(us AS VARCHAR), 6, '0') END || 'Z' AS detected_at
               FROM (SELECT *, microsecond(detected_at) % 1000000 AS us FROM alerts)"""
        ),
        "stream_alert_dedup": _alert_query(
            "SELECT id, title, severity, source, detected_at FROM alerts"
        ),
        "alert_list_status": _alert_query(f"{_LISTED} WHERE status = 'OPEN' {_NEWEST}"),
        "alert_list_severity": _alert_query(f"{_LISTED} WHERE severity = 'CRITICAL' {_NEWEST}"),
        "alert_list_range": _alert_query(
            f"""{_LISTED} WHERE detected_at >= TIMESTAMP '2024-01-05 00:00:00'
                AND detected_at < TIMESTAMP '2024-01-06 00:00:00' {_NEWEST} LIMIT 200"""
        ),
        "alert_list_since": _alert_query(
            f"{_LISTED} WHERE detected_at >= TIMESTAMP '2024-01-20 00:00:00' {_NEWEST} LIMIT 100"
        ),
        "alert_list_all": _alert_query(f"{_LISTED} {_NEWEST} LIMIT 100"),
        "alert_list_hour": _alert_query(
            f"""{_LISTED} WHERE detected_at >= TIMESTAMP '2024-01-10 10:00:00'
                AND detected_at < TIMESTAMP '2024-01-10 11:00:00' {_NEWEST} LIMIT 200"""
        ),
        "alert_status_updates": _alert_query(
            """SELECT id, CASE WHEN ok2 THEN ask2 ELSE status1 END AS status,
                      CASE WHEN ok2 AND ask2 = 'RESOLVED' THEN at2
                           WHEN ok1 AND ask1 = 'RESOLVED' THEN at1 ELSE resolved_at END AS resolved_at
               FROM steps""",
            _STATUS_STEPS,
        ),
        "alert_status_outcomes": _alert_query(
            """SELECT id AS alert_id, ask1 AS new_status, at1 AS at, status AS old_status,
                      CASE WHEN ok1 THEN 'accepted' ELSE 'rejected' END AS outcome,
                      1::BIGINT AS copies FROM steps
               UNION ALL
               SELECT id, ask2, at2, status1, CASE WHEN ok2 THEN 'accepted' ELSE 'rejected' END, 1
               FROM steps
               UNION ALL SELECT 'x' || id, 'ACK', detected_at, NULL, 'not found', 1 FROM alerts""",
            _STATUS_STEPS,
        ),
        "stream_alert_status": _alert_query(
            """SELECT id AS alert_id, ask1 AS new_status, at1 AS at, status AS old_status,
                      CASE WHEN ok1 THEN 'accepted' ELSE 'rejected' END AS outcome,
                      1::BIGINT AS copies FROM steps
               UNION ALL
               SELECT id, ask2, at2, status1, CASE WHEN ok2 THEN 'accepted' ELSE 'rejected' END, 1
               FROM steps
               UNION ALL SELECT 'x' || id, 'ACK', detected_at, NULL, 'not found', 1 FROM alerts""",
            _STATUS_STEPS,
        ),
        "alerts_open_by_severity": _alert_query(
            "SELECT severity, count(*) AS count FROM alerts WHERE status = 'OPEN' GROUP BY severity"
        ),
        "alerts_by_severity": _alert_query(
            "SELECT severity, count(*) AS count FROM alerts GROUP BY severity"
        ),
        "alerts_by_status": _alert_query(
            "SELECT status, count(*) AS count FROM alerts GROUP BY status"
        ),
        "alerts_by_source_top10": _alert_query(
            """SELECT source, count(*) AS count FROM alerts GROUP BY source
               ORDER BY count DESC, source LIMIT 10"""
        ),
        "alerts_hourly": _alert_query("SELECT hour, count FROM hours ORDER BY hour", _HOURLY),
        "alerts_totals": _alert_query(
            f"""SELECT count(*) AS total, count(*) FILTER (severity = 'CRITICAL') AS critical,
                       count(*) FILTER (severity = 'WARNING') AS warning,
                       count(*) FILTER (detected_at > {_NOW} - INTERVAL 1 HOUR) AS last_hour,
                       count(*) FILTER (detected_at > {_NOW} - INTERVAL 1 DAY) AS last_day
                FROM alerts"""
        ),
        "alerts_summary": _alert_query(
            f"""SELECT count(*) FILTER (status = 'OPEN') AS open_count,
                       count(*) FILTER (status = 'ACK') AS acknowledged_count,
                       count(*) FILTER (status = 'RESOLVED') AS resolved_count,
                       (SELECT {open_text} FROM
                         (SELECT severity, count(*) AS n FROM alerts WHERE status = 'OPEN'
                          GROUP BY severity)) AS open_by_severity
                FROM alerts"""
        ),
        "alerts_statistics": _alert_query(
            f"""SELECT count(*) AS total, count(*) FILTER (severity = 'CRITICAL') AS critical,
                       count(*) FILTER (severity = 'WARNING') AS warning,
                       count(*) FILTER (detected_at > {_NOW} - INTERVAL 1 HOUR) AS last_hour,
                       count(*) FILTER (detected_at > {_NOW} - INTERVAL 1 DAY) AS last_day,
                       (SELECT string_agg(source || '=' || n, ',' ORDER BY n DESC, source) FROM
                         (SELECT source, count(*) AS n FROM alerts GROUP BY source
                          ORDER BY n DESC, source LIMIT 10)) AS by_source,
                       (SELECT {open_text} FROM
                         (SELECT severity, count(*) AS n FROM alerts GROUP BY severity)) AS by_severity,
                       (SELECT string_agg(status || '=' || n, ',' ORDER BY status) FROM
                         (SELECT status, count(*) AS n FROM alerts GROUP BY status)) AS by_status,
                       (SELECT string_agg(CAST(hour AS VARCHAR) || '=' || count, ',' ORDER BY hour)
                        FROM hours) AS hourly
                FROM alerts""",
            _HOURLY,
        ),
        "category_share": _alert_query(
            """SELECT severity, count(*) AS count,
                      CAST(round(100.0 * count(*) / greatest(max(count(*)) OVER (), 1)) AS BIGINT)
                        AS share
               FROM alerts GROUP BY severity"""
        ),
        "hourly_bars": _alert_query(
            """SELECT hour, count,
                      CAST(floor(72.0 * count / greatest(max(count) OVER (), 1) + 0.5) AS BIGINT)
                        AS share
               FROM hours""",
            _HOURLY,
        ),
        "dashboard_summary": _alert_query(
            f"""SELECT * FROM
                (SELECT count(*) FILTER (status = 'OPEN') AS open_count,
                        count(*) FILTER (status = 'ACK') AS acknowledged_count,
                        count(*) FILTER (status = 'RESOLVED') AS resolved_count FROM alerts),
                (SELECT count(*) AS total_events, count(*) FILTER (type = 'metric') AS total_metrics,
                        count(*) FILTER (ts >= TIMESTAMP '{STORE_AS_OF}' - INTERVAL 1 HOUR)
                          AS events_last_hour,
                        count(*) FILTER (type = 'metric' AND
                          ts >= TIMESTAMP '{STORE_AS_OF}' - INTERVAL 1 HOUR) AS metrics_last_hour
                 FROM tel)"""
        ),
    }

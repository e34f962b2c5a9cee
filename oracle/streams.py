"""Events, state and metrics."""

from __future__ import annotations

from oracle.base import (
    AS_OF, COMPLETE_RULES, EVENT_TYPES, REQUIRED_MASK, count_if, failed, fsum, iso, k, seconds, with_ctes,
)

_LATENCY = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)
_BATCH = (1, 5, 10, 25, 50, 100, 250, 500, 1000)

_NULLS = {
    "pickup_zone_id": "INTEGER", "passenger_count": "INTEGER", "dropoff_zone_id": "INTEGER", "trip_distance": "DOUBLE",
    "trip_duration_minutes": "DOUBLE", "fare_amount": "DOUBLE", "tip_amount": "DOUBLE", "total_amount": "DOUBLE",
    "payment_type": "INTEGER", "zone_id": "INTEGER",
}


def _five_events(source: str) -> str:
    minutes = f"{seconds('pickup_ts', 'dropoff_ts')} / CAST(60 AS DOUBLE)"
    kinds = [
        ("trip_started", "pickup_ts", {"pickup_zone_id": "pu_zone_id", "passenger_count": "passenger_count"}),
        ("zone_entered", "pickup_ts + INTERVAL 30 SECOND", {"zone_id": "pu_zone_id"}),
        ("trip_ended", "dropoff_ts", {"dropoff_zone_id": "do_zone_id", "trip_distance": "trip_distance",
                                      "trip_duration_minutes": minutes}),
        ("zone_exited", "dropoff_ts + INTERVAL 30 SECOND", {"zone_id": "do_zone_id"}),
        ("payment_processed", "dropoff_ts + INTERVAL 60 SECOND", {c: c for c in (
            "fare_amount", "tip_amount", "total_amount", "payment_type")}),
    ]
    return " UNION ALL ".join(
        f"SELECT trip_key, vendor_id, vehicle_id_h, '{t}' AS event_type, {at} AS event_ts, "
        + ", ".join(f"{own.get(c, f'CAST(NULL AS {dtype})')} AS {c}" for c, dtype in _NULLS.items())
        + f" FROM {source}" for t, at, own in kinds)


_TRIP_EVENTS = f"""five AS ({_five_events('stg')}),
    trip_ev AS (SELECT *, sha256(trip_key || '|' || event_type) AS event_id, {iso('event_ts')} AS "timestamp" FROM five)"""


def _json_number(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


def _json() -> str:
    def text(c: str) -> str:
        return f"'\"{c}\":\"' || {c if c != 'timestamp' else chr(34) + c + chr(34)} || '\"'"
    parts = [text("event_id"), text("trip_key"), text("event_type"), text("timestamp"),
             f"'\"vendor_id\":' || {_json_number('vendor_id')}", text("vehicle_id_h"), "'\"source\":\"stream\"'"]
    for c in ("pickup_zone_id", "passenger_count", "dropoff_zone_id", "trip_distance", "trip_duration_minutes",
              "fare_amount", "tip_amount", "total_amount", "payment_type", "zone_id"):
        parts.append(f"'\"{c}\":' || {_json_number(c)}")
    parts += ["'\"zone_name\":null'", "'\"borough\":null'"]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _text(e: str, c: str) -> str:
    return f"CASE WHEN {e}.trip_key IS NOT NULL THEN coalesce(CAST({e}.{c} AS VARCHAR), 'None') END"


_LATEST = " ".join(
    f"LEFT JOIN typed {a} ON {a}.trip_key = s.trip_key AND {a}.event_type = '{t}'"
    for a, t in zip(("st", "en", "pa", "ze", "zx"), EVENT_TYPES)) + " JOIN newest n ON n.trip_key = s.trip_key"
_COMPLETE = f"(mask & {REQUIRED_MASK}) = {REQUIRED_MASK}"


def _bucket_rows(buckets: tuple, value: str, source: str, labels: str = "") -> str:
    head = f"{labels}, " if labels else ""
    group = f"GROUP BY {labels}" if labels else ""
    rows = [(f"CAST({b} AS DOUBLE)", count_if(f"{value} <= {b}")) for b in buckets]
    rows.append(("CAST(NULL AS DOUBLE)", f"count({value})"))
    return " UNION ALL ".join(
        f"SELECT {head}count({value}) AS total_count, {fsum(value)} AS total_sum, {le} AS le, {n} AS cumulative_count "
        f"FROM {source} {group}" for le, n in rows)


def _estimate(p: float) -> str:
    cases = []
    for i, b in enumerate(_LATENCY):
        lower, below = (f"CAST({_LATENCY[i - 1]} AS DOUBLE)", f"b{i - 1}") if i else ("CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)")
        cases.append(f"WHEN b{i} >= {p} * n THEN {lower} + (CAST({b} AS DOUBLE) - {lower}) * "
                     f"(CAST({p} AS DOUBLE) * n - {below}) / nullif(b{i} - {below}, 0)")
    return f"CASE {' '.join(cases)} ELSE CAST({_LATENCY[-1]} AS DOUBLE) END"


_WINDOWS = """w AS (
    SELECT date_trunc('minute', ts) - to_minutes(CAST(o.i AS INTEGER)) AS window_start, e.*
    FROM events e CROSS JOIN range(5) o(i))"""
_INGEST = "arrivals AS (SELECT *, ts + to_microseconds(CAST(round(value * 1e6) AS BIGINT)) AS ingest_ts FROM events)"
_LAG = """lag AS (SELECT date_trunc('minute', ingest_ts) AS step_ts,
    max(date_diff('microsecond', ts, ingest_ts) / 1e6) AS queue_lag_seconds FROM arrivals GROUP BY 1)"""


def _held(source: str, condition: str, rule: str, minutes: int) -> str:
    """Runs of consecutive minutes; a minute fires once its run has lasted long enough."""
    return f"""SELECT '{rule}' AS alert, step_ts AS fired_at FROM (
        SELECT step_ts, row_number() OVER (PARTITION BY island ORDER BY step_ts) AS position FROM (
            SELECT step_ts, step_ts - to_minutes(CAST(row_number() OVER (ORDER BY step_ts) AS INTEGER)) AS island
            FROM {source} WHERE {condition})) WHERE position > {minutes}"""


_LOG = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})?)\s+(DEBUG|INFO|WARN|WARNING|ERROR|CRITICAL|FATAL)\s+(?:\[([^\]]+)\]\s+)?(.*)"
_LOG_LINES = f"""lines AS (
    SELECT event_id, ts, CASE WHEN {k()} < 5 THEN 'stray output: ' || msg
        WHEN {k()} < 20 THEN {iso('ts')} || 'Z ' || level || ' ' || msg
        ELSE {iso('ts')} || 'Z ' || level || ' [assembler-' || (user_id % 5) || '] ' || msg END AS line
    FROM (SELECT *, 'processed ' || event_type || ' for user ' || user_id AS msg,
                 CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'purchase' THEN 'DEBUG'
                      ELSE 'INFO' END AS level FROM events)),
    logs AS (SELECT *, nullif(regexp_extract(line, '{_LOG}', 1), '') AS log_time,
                    nullif(regexp_extract(line, '{_LOG}', 2), '') AS level,
                    nullif(regexp_extract(line, '{_LOG}', 3), '') AS component,
                    nullif(regexp_extract(line, '{_LOG}', 4), '') AS message FROM lines)"""
_METRIC_LINES = f"""mlines AS (
    SELECT event_id, CASE WHEN n < 3 THEN '# TYPE trip_events_total counter' WHEN n < 5 THEN ''
        WHEN n < 8 THEN 'trip_events_total' || label || ' not-a-number'
        WHEN n % 2 = 0 THEN 'trip_events_total' || label || ' ' || n
        ELSE 'queue_lag_seconds' || label || ' ' || n END AS line
    FROM (SELECT event_id, {k()} AS n, '{{event_type="' || event_type || '",shard="' || user_id || '"}}' AS label FROM events)),
    samples AS (
        SELECT metric, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM (
            SELECT event_id, split_part(line, ' ', 1) AS metric, TRY_CAST(split_part(line, ' ', 2) AS DOUBLE) AS value
            FROM mlines WHERE line NOT LIKE '#%' AND trim(line) <> '' AND contains(line, ' ')
                 AND TRY_CAST(split_part(line, ' ', 2) AS DOUBLE) IS NOT NULL) GROUP BY metric)"""

_ALL_TYPES = {"trip_started": 0, "trip_ended": 1, "passenger_picked_up": 2, "passenger_dropped_off": 3,
              "payment_processed": 4, "zone_entered": 5, "zone_exited": 6}


def _latest_value(c: str, condition: str | None = None, quoted: str | None = None) -> str:
    keep = condition or f"{c} IS NOT NULL"
    return f"arg_max(CAST({quoted or c} AS VARCHAR), seq_id) FILTER (WHERE {keep})"


_FIELD_STATE = ", ".join(
    [f"{_latest_value(c)} AS {c}" for c in ("vendor_id", "vehicle_id_h", "pickup_zone_id", "dropoff_zone_id",
                                            "passenger_count", "payment_type")]
    + [f"CAST({_latest_value(c)} AS DOUBLE) AS {c}" for c in ("fare_amount", "tip_amount", "total_amount")]
    + [f"CAST(NULL AS VARCHAR) AS {c}" for c in ("distance_km", "duration_min", "avg_speed_kmh")]
    + [f"arg_max({iso('event_ts')}, seq_id) FILTER (WHERE event_type = '{t}' AND event_ts IS NOT NULL) AS {t}_timestamp, "
       + f"{_latest_value('event_id', f'''event_type = '{t}' ''')} AS {t}_event_id" for t in _ALL_TYPES])

_STREAM_TRIPS = f"""
        SELECT s.trip_key, n.vendor_id, st.event_ts AS pickup_ts, en.event_ts AS dropoff_ts,
               st.pickup_zone_id AS pu_zone_id, en.dropoff_zone_id AS do_zone_id,
               coalesce(st.passenger_count, 0) AS passenger_count, en.trip_distance,
               coalesce(pa.fare_amount, 0) AS fare_amount, coalesce(pa.tip_amount, 0) AS tip_amount,
               coalesce(pa.total_amount, 0) AS total_amount, pa.payment_type, n.vehicle_id_h, 'stream' AS source,
               {AS_OF} AS created_at, {AS_OF} AS updated_at FROM state s {_LATEST} WHERE {_COMPLETE}"""

_GOOD_TRIPS = f"""
        SELECT n.trip_key, n.vendor_id, st.event_ts AS pickup_ts, en.event_ts AS dropoff_ts,
               st.pickup_zone_id AS pu_zone_id, en.dropoff_zone_id AS do_zone_id,
               coalesce(st.passenger_count, 0) AS passenger_count, en.trip_distance,
               coalesce(pa.fare_amount, 0) AS fare_amount, coalesce(pa.tip_amount, 0) AS tip_amount,
               coalesce(pa.total_amount, 0) AS total_amount, pa.payment_type, n.vehicle_id_h, 'stream' AS source,
               {AS_OF} AS created_at, {AS_OF} AS updated_at
        FROM good_newest n
        JOIN good_typed st ON st.trip_key = n.trip_key AND st.event_type = 'trip_started'
        JOIN good_typed en ON en.trip_key = n.trip_key AND en.event_type = 'trip_ended'
        JOIN good_typed pa ON pa.trip_key = n.trip_key AND pa.event_type = 'payment_processed'"""

_LAST_OF_KEPT = """good_typed AS (SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY trip_key, event_type ORDER BY event_ts DESC, event_id DESC) AS rn FROM kept) WHERE rn = 1),
        good_newest AS (SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY trip_key ORDER BY event_ts DESC, event_id DESC) AS rn FROM kept) WHERE rn = 1)"""

SQL: dict[str, str] = {
    "trip_events": with_ctes("stg", f"""
        WITH {_TRIP_EVENTS}
        SELECT event_id, trip_key, event_type, "timestamp", vendor_id, vehicle_id_h, {', '.join(_NULLS)} FROM trip_ev"""),
    "events_json": with_ctes("stg", f"WITH {_TRIP_EVENTS} SELECT trip_key AS key, {_json()} AS value FROM trip_ev"),
    "event_stats": with_ctes("validated", f"""
        SELECT {count_if("failed_rules = ''")} AS trips_processed, {count_if("failed_rules <> ''")} AS trips_failed,
               {count_if("failed_rules = ''")} * 5 AS events_generated FROM validated"""),
    "late_events": with_ctes("stg", f"""
        WITH {_TRIP_EVENTS}, marked AS (
            SELECT *, CAST('0x' || substr(sha256(trip_key), 1, 8) AS BIGINT) % 100 < 3 AS is_late FROM trip_ev)
        SELECT trip_key, event_type, event_ts, is_late,
               CASE WHEN is_late THEN event_ts + INTERVAL 600 SECOND ELSE event_ts END AS arrival_ts FROM marked"""),
    "parse_events": with_ctes("parsed", """
        SELECT seq_id, event_id, trip_key, event_type, event_ts, vendor_id, vehicle_id_h, source, pickup_zone_id,
               passenger_count, dropoff_zone_id, trip_distance, CAST(NULL AS DOUBLE) AS trip_duration_minutes,
               fare_amount, tip_amount, total_amount, payment_type, zone_id, reject_reason FROM parsed"""),
    "normalize_events": with_ctes("msg", f"""
        SELECT seq_id, trip_key, event_type, {iso('event_ts')} AS "timestamp", event_id,
               CAST(vendor_id AS VARCHAR) AS vendor_id, vehicle_id_h, CAST(pickup_zone_id AS VARCHAR) AS pickup_zone_id,
               CAST(dropoff_zone_id AS VARCHAR) AS dropoff_zone_id, CAST(passenger_count AS VARCHAR) AS passenger_count,
               CAST(payment_type AS VARCHAR) AS payment_type, fare_amount, tip_amount, total_amount,
               CAST(NULL AS VARCHAR) AS distance_km,
               CAST(NULL AS VARCHAR) AS duration_min, CAST(NULL AS VARCHAR) AS avg_speed_kmh,
               event_ts IS NULL AS bad_timestamp
        FROM msg WHERE trip_key <> '' AND event_type <> ''"""),
    "event_type_counts": with_ctes("parsed", """
        SELECT event_type, source AS service, count(*) AS events FROM parsed WHERE reject_reason IS NULL GROUP BY 1, 2"""),
    "event_state": with_ctes("typed", """
        SELECT trip_key, event_type, event_id, "timestamp", vendor_id, vehicle_id_h, pickup_zone_id, passenger_count,
               dropoff_zone_id, trip_distance, fare_amount, tip_amount, total_amount, payment_type, zone_id
        FROM typed"""),
    "field_state": with_ctes("msg", f"""
        SELECT trip_key, {_FIELD_STATE} FROM msg WHERE trip_key <> '' AND event_type <> '' GROUP BY 1"""),
    "trip_sessions": with_ctes("ev", f"""
        WITH gaps AS (SELECT *, CASE WHEN event_ts - lag(event_ts) OVER o > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS cut
                      FROM ev WINDOW o AS (PARTITION BY trip_key ORDER BY event_ts, seq_id)),
        numbered AS (SELECT *, sum(cut) OVER (PARTITION BY trip_key ORDER BY event_ts, seq_id) AS session FROM gaps)
        SELECT trip_key, min(event_ts) AS session_start, max(event_ts) + INTERVAL 6 HOUR AS session_end,
               count(*) AS events,
               (bit_or(CASE event_type WHEN 'trip_started' THEN 1 WHEN 'trip_ended' THEN 2
                       WHEN 'payment_processed' THEN 16 ELSE 0 END) & {REQUIRED_MASK}) = {REQUIRED_MASK} AS complete
        FROM numbered GROUP BY trip_key, session"""),
    "complete_trips": with_ctes("state", f"SELECT trip_key, mask FROM state WHERE {_COMPLETE}"),
    "complete_mask": with_ctes("state", f"SELECT trip_key, mask, {_COMPLETE} AS complete FROM state"),
    "missing_events": with_ctes("state", f"""
        SELECT trip_key, concat_ws(',', CASE WHEN mask & 1 = 0 THEN 'trip_started' END,
                   CASE WHEN mask & 2 = 0 THEN 'trip_ended' END, CASE WHEN mask & 16 = 0 THEN 'payment_processed' END)
               AS missing FROM state WHERE NOT {_COMPLETE}"""),
    "partial_trip_count": with_ctes("state", f"SELECT {count_if(f'NOT ({_COMPLETE})')} AS open_trips FROM state"),
    "trip_snapshots": with_ctes("state typed newest", f"""
        SELECT s.trip_key, CAST(n.vendor_id AS VARCHAR) AS vendor_id, {_text('pa', 'fare_amount')} AS fare_amount,
               {_text('st', 'passenger_count')} AS passenger_count, {_text('pa', 'tip_amount')} AS tip_amount,
               {_text('pa', 'total_amount')} AS total_amount, st."timestamp" AS trip_started_timestamp,
               en."timestamp" AS trip_ended_timestamp, pa."timestamp" AS payment_processed_timestamp,
               ze."timestamp" AS zone_entered_timestamp, zx."timestamp" AS zone_exited_timestamp
        FROM state s {_LATEST}"""),
    "assembled_trips": with_ctes("state typed newest", f"""
        SELECT s.trip_key, n.vendor_id, coalesce(pa.fare_amount, 0) AS fare_amount,
               coalesce(st.passenger_count, 0) AS passenger_count, coalesce(pa.tip_amount, 0) AS tip_amount,
               coalesce(pa.total_amount, 0) AS total_amount FROM state s {_LATEST} WHERE {_COMPLETE}"""),
    "assembled_trips_full": with_ctes("state typed newest", _STREAM_TRIPS),
    "fk_orphans": with_ctes("state typed newest zone", f"""
        WITH trips AS ({_STREAM_TRIPS})
        SELECT CAST((SELECT count(*) FROM trips t LEFT JOIN zone z ON t.pu_zone_id = z.zone_id WHERE z.zone_id IS NULL)
                    AS BIGINT) AS invalid_pu_zone_refs,
               CAST((SELECT count(*) FROM trips t LEFT JOIN zone z ON t.do_zone_id = z.zone_id WHERE z.zone_id IS NULL)
                    AS BIGINT) AS invalid_do_zone_refs"""),
    "fk_enforce": with_ctes("state typed newest zone", f"""
        WITH trips AS ({_STREAM_TRIPS})
        SELECT trip_key, CASE WHEN pu_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'pu_zone_unknown'
                              WHEN do_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'do_zone_unknown'
                              ELSE 'kept' END AS outcome FROM trips"""),
    "dq_documented_rules": with_ctes("state typed newest zone", f"WITH trips AS ({_STREAM_TRIPS}) " + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(CASE WHEN NOT coalesce({cond}, false) THEN 1 END) AS failed FROM trips" for name, cond in {
            "duration": "date_diff('microsecond', pickup_ts, dropoff_ts) BETWEEN 1000000 AND 86400000000",
            "fare": "fare_amount BETWEEN CAST(0.01 AS DOUBLE) AND 500",
            "zones": "pu_zone_id IN (SELECT zone_id FROM zone) AND do_zone_id IN (SELECT zone_id FROM zone)",
            "chronological": "pickup_ts < dropoff_ts",
        }.items())),
    "fk_orphans_staged": with_ctes("stg zone", """
        WITH trips AS (SELECT * FROM stg)
        SELECT CAST((SELECT count(*) FROM trips t LEFT JOIN zone z ON t.pu_zone_id = z.zone_id WHERE z.zone_id IS NULL)
                    AS BIGINT) AS invalid_pu_zone_refs,
               CAST((SELECT count(*) FROM trips t LEFT JOIN zone z ON t.do_zone_id = z.zone_id WHERE z.zone_id IS NULL)
                    AS BIGINT) AS invalid_do_zone_refs"""),
    "fk_enforce_staged": with_ctes("stg zone", """
        WITH trips AS (SELECT * FROM stg)
        SELECT CASE WHEN pu_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'pu_zone_unknown'
                              WHEN do_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'do_zone_unknown'
                              ELSE 'kept' END AS outcome, count(*) AS trips FROM trips GROUP BY 1"""),
    "dq_documented_rules_staged": with_ctes("stg zone", "WITH trips AS (SELECT * FROM stg) " + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(CASE WHEN NOT coalesce({cond}, false) THEN 1 END) AS failed FROM trips" for name, cond in {
            "duration": "date_diff('microsecond', pickup_ts, dropoff_ts) BETWEEN 1000000 AND 86400000000",
            "fare": "fare_amount BETWEEN CAST(0.01 AS DOUBLE) AND 500",
            "zones": "pu_zone_id IN (SELECT zone_id FROM zone) AND do_zone_id IN (SELECT zone_id FROM zone)",
            "chronological": "pickup_ts < dropoff_ts",
        }.items())),
    "assembled_trips_stream": with_ctes("good_typed good_newest", _GOOD_TRIPS),
    # a gap of more than six hours ends a trip's state; the latest complete stretch of a trip is what stays in the table
    "expiring_trips_stream": with_ctes("good", f"""
        WITH gaps AS (SELECT *, CASE WHEN event_ts - lag(event_ts) OVER o > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS cut
                      FROM good WINDOW o AS (PARTITION BY trip_key ORDER BY event_ts, seq_id)),
        stretches AS (SELECT *, sum(cut) OVER (PARTITION BY trip_key ORDER BY event_ts, seq_id) AS stretch FROM gaps),
        whole AS (SELECT trip_key, max(stretch) AS stretch FROM (
            SELECT trip_key, stretch FROM stretches WHERE event_type IN ('trip_started', 'trip_ended', 'payment_processed')
            GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 3) GROUP BY 1),
        kept AS (SELECT * FROM stretches JOIN whole USING (trip_key, stretch)),
        {_LAST_OF_KEPT}
        {_GOOD_TRIPS}"""),
    "deleted_trips_stream": with_ctes("good ev", f"""
        WITH cuts AS (SELECT trip_key, max(event_ts) AS deleted FROM ev WHERE event_type = 'zone_exited' AND k % 2 = 0 GROUP BY 1),
        kept AS (SELECT g.* FROM good g LEFT JOIN cuts c USING (trip_key) WHERE deleted IS NULL OR event_ts > deleted),
        {_LAST_OF_KEPT}
        {_GOOD_TRIPS}"""),
    "stream_outcomes": with_ctes("good_typed good_newest zone", f"""
        WITH trips AS ({_GOOD_TRIPS}), judged AS (SELECT *, {failed(COMPLETE_RULES)} AS failed_rules FROM trips)
        SELECT trip_key, CASE WHEN failed_rules <> '' THEN 'rule:' || split_part(failed_rules, ',', 1)
                              WHEN pu_zone_id IS NULL OR pu_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'pu_zone_unknown'
                              WHEN do_zone_id IS NULL OR do_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'do_zone_unknown'
                              ELSE 'kept' END AS outcome FROM judged"""),
    "field_state_stream": with_ctes("msg", f"""
        SELECT trip_key, {_FIELD_STATE} FROM msg WHERE trip_key <> '' AND event_type <> '' GROUP BY 1"""),
    "assembly_round_trip": with_ctes("uniq", "SELECT * FROM uniq"),
    "assembly_stats": with_ctes("parsed", """
        WITH valid AS (SELECT * FROM parsed WHERE reject_reason IS NULL),
        done AS (SELECT trip_key, greatest(min(CASE WHEN event_type = 'trip_started' THEN seq_id END),
                        min(CASE WHEN event_type = 'trip_ended' THEN seq_id END),
                        min(CASE WHEN event_type = 'payment_processed' THEN seq_id END)) AS completed_at
                 FROM valid GROUP BY 1
                 HAVING count(DISTINCT CASE WHEN event_type IN ('trip_started', 'trip_ended', 'payment_processed')
                                            THEN event_type END) = 3)
        SELECT (SELECT count(*) FROM parsed) AS events,
               (SELECT count(*) FROM valid JOIN done USING (trip_key) WHERE seq_id >= completed_at) AS trips_completed,
               CAST(ceil((SELECT count(*) FROM parsed) / 500) AS BIGINT) AS commits"""),
    "dedup_events": with_ctes("ev", 'SELECT event_id, trip_key, event_type, "timestamp" FROM ev'),
    "latency_histogram": _bucket_rows(_LATENCY, "value", "events", "event_type"),
    "latency_quantiles": f"""
        WITH c AS (SELECT event_type, CAST(count(value) AS DOUBLE) AS n, """ + ", ".join(
            f"CAST({count_if(f'value <= {b}')} AS DOUBLE) AS b{i}" for i, b in enumerate(_LATENCY)
        ) + " FROM events GROUP BY 1) " + " UNION ALL ".join(
            f"SELECT event_type, CAST({p} AS DOUBLE) AS probability, {_estimate(p)} AS estimate FROM c" for p in (0.5, 0.9)),
    "batch_size_histogram": f"""
        WITH b AS (SELECT count(*) AS size FROM events GROUP BY user_id, date_trunc('day', ts))
        {_bucket_rows(_BATCH, 'size', 'b')}""",
    "queue_lag": f"WITH {_INGEST}, {_LAG} SELECT * FROM lag",
    "event_rate_5m": f"""
        WITH {_WINDOWS}
        SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) / 300.0 AS events_per_second,
               {fsum("CASE WHEN event_type = 'purchase' THEN value END")} / CAST(300 AS DOUBLE) AS amount_per_second
        FROM w GROUP BY 1""",
    "alerts": f"""
        WITH {_INGEST}, {_LAG}, {_WINDOWS},
        failures AS (SELECT window_start + INTERVAL 5 MINUTE AS step_ts,
                            {count_if("event_type = 'error'")} / 300.0 AS failures_per_second,
                            {count_if("event_type = 'error'")} / 300.0 / greatest(count(*) / 300.0, 1) AS error_share
                     FROM w GROUP BY 1)
        {_held('lag', 'queue_lag_seconds > 30', 'processing_lag', 2)}
        UNION ALL {_held('failures', 'failures_per_second > 0.003', 'quality_failures', 3)}
        UNION ALL {_held('failures', 'error_share > 0.003', 'error_share', 3)}""",
    "log_parse": f"WITH {_LOG_LINES} SELECT event_id, log_time, level, component, message FROM logs",
    "log_filter": f"WITH {_LOG_LINES} SELECT event_id, log_time, level, message FROM logs WHERE level = 'ERROR'",
    "log_volume": f"""
        WITH {_LOG_LINES}
        SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, level, count(*) AS lines,
               {count_if("regexp_matches(level, 'WARN|ERROR|CRITICAL|FATAL')")} AS problem_lines FROM logs GROUP BY 1, 2""",
    "parse_metric_lines": f"WITH {_METRIC_LINES} SELECT * FROM samples",
    "metric_total": f"WITH {_METRIC_LINES} SELECT {fsum('value')} AS total FROM samples WHERE contains(metric, 'trip_events_total')",
}

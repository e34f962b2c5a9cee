"""Sources, derived columns, quality, validation, staging and upserts."""

from __future__ import annotations

from oracle.base import (
    MART_DECIMALS,
    COMPLETE_RULES, CREATE_RULES, CURATED_COLUMNS, SALT, STAGED_COLUMNS, UPDATE_RULES, between, count_if, failed,
    favg, fsum, pct, seconds, with_ctes,
)

_UPSERT = f"""
    WITH first_load AS (SELECT {STAGED_COLUMNS} FROM uniq WHERE CAST(pickup_ts AS DATE) <= DATE '2025-01-10'),
    latest AS (
        SELECT * REPLACE ('stream-2' AS source, total_amount + 2 AS total_amount)
        FROM uniq WHERE CAST(pickup_ts AS DATE) >= DATE '2025-01-08'),
    merged AS (
        SELECT * FROM first_load WHERE trip_key NOT IN (SELECT trip_key FROM latest)
        UNION ALL SELECT * FROM latest)
"""

_MEASURES = f"""count(*) AS input_rows, {count_if('reject_reason IS NULL')} AS output_rows,
    {pct(count_if('reject_reason IS NULL'), 'count(*)')} AS retention_rate,
    {count_if("reject_reason = 'temporal_invalid'")} AS temporal_invalid,
    {count_if("reject_reason = 'speed_invalid'")} AS speed_invalid,
    {count_if("reject_reason = 'negative_amount'")} AS negative_amount"""

_ISSUES = {
    "negative_fare": "fare_amount < 0",
    "zero_distance": "trip_distance = 0",
    "negative_duration": "duration_min < 0",
    "zero_duration": "duration_min = 0",
    "null_pickup_zone": "pu_zone_id IS NULL",
    "null_dropoff_zone": "do_zone_id IS NULL",
}


def _each(rows: dict[str, str], template: str) -> str:
    return " UNION ALL ".join(template.format(name=n, cond=c) for n, c in rows.items())


def _sanity() -> str:
    columns = {
        "tpep_pickup_datetime": "pickup_ts", "PULocationID": "pu_zone_id", "DOLocationID": "do_zone_id",
        "fare_amount": "fare_amount", "tip_amount": "tip_amount", "trip_distance": "trip_distance",
    }
    parts = []
    for name, c in columns.items():
        counted = name != "trip_distance"
        ranged = name in ("fare_amount", "trip_distance")
        nulls = count_if(f"{c} IS NULL")
        parts.append(f"""SELECT '{name}' AS column_name, true AS present,
            {nulls if counted else 'CAST(NULL AS BIGINT)'} AS null_count,
            {pct(nulls, 'count(*)') if counted else 'CAST(NULL AS DOUBLE)'} AS null_pct,
            {f'min({c})' if ranged else 'CAST(NULL AS DOUBLE)'} AS min_value,
            {f'max({c})' if ranged else 'CAST(NULL AS DOUBLE)'} AS max_value,
            {favg(c) if ranged else 'CAST(NULL AS DOUBLE)'} AS avg_value FROM raw""")
    return " UNION ALL ".join(parts)


_FARES = " UNION ALL ".join([
    "SELECT 'IDENTITY' AS event_type, pickup_ts AS event_ts, trip_key, vehicle_id_h, vendor_id, pu_zone_id, "
    "do_zone_id, CAST(NULL AS INTEGER) AS passenger_count, CAST(NULL AS DOUBLE) AS fare_amount, "
    "CAST(NULL AS DOUBLE) AS total_amount, CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS INTEGER) AS payment_type, "
    "pickup_ts, CAST(NULL AS TIMESTAMP) AS dropoff_ts, CAST(NULL AS DOUBLE) AS trip_distance FROM record",
    "SELECT 'PASSENGERS', pickup_ts + INTERVAL 10 SECOND, trip_key, vehicle_id_h, NULL, NULL, NULL, passenger_count, "
    "NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM record",
    "SELECT 'FARE', dropoff_ts, trip_key, vehicle_id_h, NULL, NULL, NULL, NULL, fare_amount, total_amount, NULL, "
    "payment_type, NULL, NULL, trip_distance FROM record",
    "SELECT 'DROP', dropoff_ts, trip_key, vehicle_id_h, NULL, NULL, do_zone_id, NULL, NULL, total_amount, NULL, NULL, "
    "NULL, dropoff_ts, NULL FROM record",
    "SELECT CASE WHEN tip_amount = 0 THEN 'REFUND' ELSE 'TIP' END, dropoff_ts + INTERVAL 60 SECOND, trip_key, "
    "vehicle_id_h, NULL, NULL, NULL, NULL, NULL, NULL, tip_amount, NULL, NULL, NULL, NULL FROM record",
])

_CONTRACT_RULES = {
    "IDENTITY": [("vendor_id", between("vendor_id", 1, 6)), ("pickup_ts", "pickup_ts IS NOT NULL"),
                 ("pu_zone_id", between("pu_zone_id", 1, 265)), ("do_zone_id", between("do_zone_id", 1, 265))],
    "PASSENGERS": [("passenger_count", between("passenger_count", 0, 9))],
    "FARE": [("fare_amount", "fare_amount >= 0"), ("trip_distance", "trip_distance >= 0"),
             ("payment_type", between("payment_type", 1, 6))],
    "DROP": [("dropoff_ts", "dropoff_ts IS NOT NULL"), ("do_zone_id", between("do_zone_id", 1, 265)),
             ("total_amount", "total_amount >= 0")],
    "TIP": [("tip_amount", "tip_amount >= 0")],
}
_BASE_RULES = [("event_ts", "event_ts IS NOT NULL"), ("trip_key", "length(trip_key) <= 64"),
               ("vehicle_id_h", "length(vehicle_id_h) <= 16")]
_CONTRACT_FAILED = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN {failed(_BASE_RULES + r)}" for t, r in _CONTRACT_RULES.items()
) + f" ELSE concat_ws(',', nullif({failed(_BASE_RULES)}, ''), 'event_type') END"

SQL: dict[str, str] = {
    "curate_pending_months": """
        SELECT DISTINCT 'raw/yellow/' || strftime(o_orderdate, '%Y/%m/') || 'yellow_tripdata_'
                   || strftime(o_orderdate, '%Y-%m') || '.parquet' AS path,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') NOT IN (SELECT strftime(ts, '%Y-%m') FROM events)""",
    "curate_sample": with_ctes("raw", f"""
        WITH head AS (SELECT * FROM raw ORDER BY row_offset, trip_distance, pickup_ts, do_zone_id, tip_amount LIMIT 1000),
        t AS (SELECT *, trip_distance * CAST(1.60934 AS DOUBLE) AS distance_km,
                     {seconds('pickup_ts', 'dropoff_ts')} / CAST(60 AS DOUBLE) AS duration_min FROM head),
        s AS (SELECT *, CASE WHEN duration_min <> 0 THEN distance_km / (nullif(duration_min, 0) / CAST(60 AS DOUBLE)) END
                     AS avg_speed_kmh FROM t)
        SELECT {CURATED_COLUMNS} FROM s
        WHERE pickup_ts < dropoff_ts AND coalesce(avg_speed_kmh <= 200, true) AND total_amount >= 0"""),
    "load_zones": with_ctes("zone", "SELECT *, 'empty' AS target FROM zone"),
    "upsert_trips": with_ctes("uniq", f"{_UPSERT} SELECT * FROM merged"),
    "reconcile_source": with_ctes("uniq", f"""{_UPSERT}
        SELECT source, count(*) AS trips, min(pickup_ts) AS first_trip, max(pickup_ts) AS last_trip,
               {fsum('total_amount')} AS total_revenue FROM merged GROUP BY source"""),
    "upsert_kpis": with_ctes("kpi", f"""
        WITH doubled AS (
            SELECT pu_zone_id AS zone_id, date_trunc('hour', pickup_ts) AS hour_ts, {favg('fare_amount * 2')} AS avg_fare
            FROM stg GROUP BY 1, 2),
        target AS (SELECT * FROM kpi WHERE hour_ts < TIMESTAMP '2025-01-11 00:00:00'),
        latest AS (SELECT kpi.* REPLACE (doubled.avg_fare AS avg_fare)
                   FROM kpi JOIN doubled USING (zone_id, hour_ts)
                   WHERE hour_ts >= TIMESTAMP '2025-01-08 00:00:00' AND hour_ts < TIMESTAMP '2025-01-15 00:00:00')
        SELECT CAST(zone_id AS INTEGER) AS zone_id, hour_ts, CAST(trips AS INTEGER) AS trips,
               CAST(unique_vehicles AS INTEGER) AS unique_vehicles, {MART_DECIMALS}
        FROM (SELECT * FROM target WHERE hour_ts < TIMESTAMP '2025-01-08 00:00:00' UNION ALL SELECT * FROM latest)"""),
    "reject_ledger": with_ctes("flagged validated zone", """
        WITH judged AS (SELECT CASE WHEN failed_rules <> '' THEN 'rule:' || split_part(failed_rules, ',', 1)
                                    WHEN pu_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'pu_zone_unknown'
                                    WHEN do_zone_id NOT IN (SELECT zone_id FROM zone) THEN 'do_zone_unknown'
                                    ELSE 'kept' END AS reason FROM validated)
        SELECT 'curation' AS stage, reject_reason AS reason, count(*) AS trips FROM flagged WHERE reject_reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'staging', reason, count(*) FROM judged GROUP BY 2"""),
    "trips_first_n": with_ctes("uniq", "SELECT * FROM uniq ORDER BY pickup_ts, trip_key LIMIT 100"),
    "derived_fields": with_ctes("derived", """
        SELECT row_offset, pickup_ts AS tpep_pickup_datetime, trip_distance, distance_km, duration_min, avg_speed_kmh
        FROM derived"""),
    "derived_ranges": with_ctes("derived", "SELECT " + ", ".join(
        f"{f}({c}) AS {c}_{f}" for c in ("distance_km", "duration_min", "avg_speed_kmh") for f in ("min", "max")
    ) + " FROM derived"),
    "standardize_columns": with_ctes("raw", "SELECT * FROM raw"),
    "trip_keys": with_ctes("keyed_raw", "SELECT row_offset, vendor_id, pickup_ts, pu_zone_id, trip_key FROM keyed_raw"),
    "vehicle_ids": with_ctes("keyed_raw", """
        SELECT vehicle_id_h, count(*) AS trips, min(row_offset) AS first_row FROM keyed_raw GROUP BY 1"""),
    "to_complete_trip": with_ctes("record", f"""
        SELECT {STAGED_COLUMNS}, store_and_fwd_flag, rate_code, tolls_amount, congestion_surcharge, airport_fee,
               distance_km, duration_min, avg_speed_kmh FROM record"""),
    "trip_properties": with_ctes("stg", f"""
        SELECT trip_key, {seconds('pickup_ts', 'dropoff_ts')} / CAST(60 AS DOUBLE) AS trip_duration_minutes,
               coalesce(tip_amount > 0, false) AS has_tip,
               coalesce(vendor_id <> 0 AND pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND pu_zone_id <> 0
                        AND do_zone_id <> 0 AND trip_key <> '' AND vehicle_id_h <> '', false) AS is_complete FROM stg"""),
    "safe_parse": """
        SELECT o_orderkey, 0 AS bad_int, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS good_int, 0 AS decimal_int,
               CAST(printf('%.2f', o_totalprice) AS DOUBLE) AS good_float, CAST(0 AS DOUBLE) AS bad_float, 0 AS null_int
        FROM orders""",
    "dq_filter": with_ctes("flagged", """
        SELECT row_offset, pickup_ts AS tpep_pickup_datetime, dropoff_ts AS tpep_dropoff_datetime, avg_speed_kmh,
               total_amount FROM flagged WHERE reject_reason IS NULL"""),
    "dq_rejections": with_ctes("flagged", " UNION ALL ".join(
        f"SELECT '{r}' AS rule, {count_if(f'''reject_reason = '{r}' ''')} AS rejected FROM flagged"
        for r in ("temporal_invalid", "speed_invalid", "negative_amount"))),
    "curation_stats": with_ctes("flagged", f"SELECT {_MEASURES} FROM flagged"),
    "curation_summary": with_ctes("flagged", f"""
        SELECT strftime(pickup_ts, '%Y-%m') AS month, {_MEASURES} FROM flagged GROUP BY 1
        UNION ALL SELECT 'TOTAL', {_MEASURES} FROM flagged"""),
    "validate_trips": with_ctes("validated", "SELECT trip_key, vendor_id, failed_rules FROM validated"),
    "validate_trip_create": with_ctes("record", f"SELECT trip_key, {failed(CREATE_RULES)} AS failed_rules FROM record"),
    "validate_trip_update": with_ctes("raw", f"""
        SELECT row_offset, total_amount, {failed(UPDATE_RULES)} AS failed_rules FROM raw"""),
    "validate_zones": with_ctes("zone", f"""
        SELECT zone_id, zone_name, {failed([("zone_id", "zone_id IS NOT NULL"), ("borough", "length(borough) <= 50"),
            ("zone_name", "length(zone_name) <= 100"), ("service_zone", "length(service_zone) <= 50")])} AS failed_rules
        FROM zone"""),
    "validate_contract_events": with_ctes("record", f"""
        WITH contract AS ({_FARES}), checked AS (SELECT *, {_CONTRACT_FAILED} AS failed_rules FROM contract)
        SELECT event_type, failed_rules, count(*) AS events, min(event_ts) AS first_event, max(trip_key) AS last_key
        FROM checked GROUP BY 1, 2"""),
    "flatten_contract": with_ctes("record", f"""
        WITH contract AS ({_FARES})
        SELECT trip_key, event_type, '1' AS event_version, event_ts, vehicle_id_h, vendor_id, pu_zone_id, do_zone_id,
               passenger_count, fare_amount, total_amount, tip_amount, payment_type, pickup_ts, dropoff_ts
        FROM contract"""),
    "verify_curated": with_ctes("curated", """
        SELECT strftime(pickup_ts, '%Y-%m') AS month, count(*) AS row_count,
               bool_and(coalesce(pickup_ts < dropoff_ts, false)) AS temporal_ok,
               bool_and(avg_speed_kmh IS NULL OR avg_speed_kmh <= 200) AS speed_ok,
               bool_and(coalesce(total_amount >= 0, false)) AS amount_ok FROM curated GROUP BY 1"""),
    "sanity_check": with_ctes("raw", _sanity()),
    "dq_issue_counts": with_ctes("timed", _each(_ISSUES,
        "SELECT '{name}' AS issue, count(CASE WHEN {cond} THEN 1 END) AS row_count, "
        "1e2 * count(CASE WHEN {cond} THEN 1 END) / nullif(count(*), 0) AS row_pct FROM timed")),
    "null_audit": with_ctes("record", "SELECT " + ", ".join(
        f"count(CASE WHEN {c} IS NULL THEN 1 END) AS null_{c}" for c in (
            "trip_key", "vendor_id", "pickup_ts", "dropoff_ts", "pu_zone_id", "do_zone_id", "vehicle_id_h",
            "passenger_count", "congestion_surcharge")) + " FROM record"),
    "trips_with_zones": with_ctes("stg zone", """
        SELECT trip_key, pu_zone_id, p.borough AS pu_borough, p.zone_name AS pu_zone_name,
               p.service_zone AS pu_service_zone, do_zone_id, d.borough AS do_borough, d.zone_name AS do_zone_name,
               d.service_zone AS do_service_zone
        FROM stg JOIN zone p ON pu_zone_id = p.zone_id JOIN zone d ON do_zone_id = d.zone_id"""),
    "trip_lookup": with_ctes("uniq", "SELECT * FROM uniq WHERE trip_key = (SELECT max(trip_key) FROM stg)"),
    "trip_outcomes": with_ctes("validated", """
        SELECT 'batch' AS service, CASE WHEN failed_rules = '' THEN 'completed' ELSE 'failed' END AS status,
               coalesce(nullif(split_part(failed_rules, ',', 1), ''), 'none') AS error_type, count(*) AS trips
        FROM validated GROUP BY ALL"""),
    "dq_failures": with_ctes("validated", """
        SELECT rule, count(*) AS failures
        FROM (SELECT unnest(string_split(failed_rules, ',')) AS rule FROM validated WHERE failed_rules <> '') GROUP BY 1"""),
}

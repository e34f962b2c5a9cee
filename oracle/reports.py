"""KPIs, reports, profiles and statistics."""

from __future__ import annotations

from oracle.base import AS_OF, CURATED_COLUMNS, MART_DECIMALS, count_if, favg, fsum, pct, seconds, with_ctes

_NUMERIC = ("passenger_count", "trip_distance", "payment_type", "fare_amount", "tip_amount", "total_amount",
            "distance_km", "duration_min", "avg_speed_kmh")
_KEY_METRICS = ("distance_km", "duration_min", "avg_speed_kmh", "fare_amount")
_QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
_CAPS = {"distance_km": 50, "duration_min": 60, "avg_speed_kmh": 100, "fare_amount": 100}


def _stats(metric: str, column: str, source: str, quantiles: dict[str, float]) -> str:
    value = f"CAST({column} AS DOUBLE)"
    extra = "".join(f", quantile_cont({value}, {q}) AS {n}" for n, q in quantiles.items())
    return f"""SELECT '{metric}' AS metric, count({column}) AS row_count, {favg(column)} AS mean,
        round(stddev_samp({value}), 6) AS std, min({value}) AS min, max({value}) AS max{extra} FROM {source}"""


def _value_counts(columns: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, CAST({c} AS BIGINT) AS value, count(*) AS row_count,
            {pct('count(*)', f'(SELECT count(*) FROM {source})')} AS pct
            FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}""" for name, c in columns.items())


_PLAUSIBLE = """plausible AS (SELECT *, duration_min AS trip_duration_min FROM timed
    WHERE trip_distance > 0 AND trip_distance < 100 AND duration_min > 0 AND duration_min < 180)"""
_SPEEDS = """mph AS (SELECT trip_distance / (nullif(trip_duration_min, 0) / CAST(60 AS DOUBLE)) AS avg_speed_mph FROM plausible),
    valid AS (SELECT * FROM mph WHERE avg_speed_mph > 0 AND avg_speed_mph < 60)"""
_MEDIAN = {"median": 0.5}

_HISTOGRAMS = " UNION ALL ".join(f"""
    SELECT '{m}' AS metric, CAST(b.bin AS INTEGER) AS bin, r.lo + b.bin * (r.hi - r.lo) / 50 AS bin_start,
           count(v.{m}) AS row_count, r.median
    FROM (SELECT min({m}) FILTER (WHERE {m} <= {cap}) AS lo, max({m}) FILTER (WHERE {m} <= {cap}) AS hi,
                 quantile_cont({m}, 0.5) AS median FROM curated) r
    CROSS JOIN range(50) b(bin)
    LEFT JOIN (SELECT {m} FROM curated WHERE {m} <= {cap}) v
           ON least(floor((v.{m} - r.lo) * 50 / (r.hi - r.lo)), 49) = b.bin
    GROUP BY ALL""" for m, cap in _CAPS.items())

_MONTHS = f"""count(*) AS row_count, {favg('distance_km')} AS avg_distance_km, {favg('duration_min')} AS avg_duration_min,
    {favg('fare_amount')} AS avg_fare_amount"""

SQL: dict[str, str] = {
    "zone_hourly_kpis": with_ctes("kpi", "SELECT * FROM kpi"),
    "kpi_full_refresh": with_ctes("kpi", f"""
        SELECT CAST(zone_id AS INTEGER) AS zone_id, hour_ts, CAST(trips AS INTEGER) AS trips,
               CAST(unique_vehicles AS INTEGER) AS unique_vehicles,
               {MART_DECIMALS}, {AS_OF} AS created_at, true AS no_outlier_rate
        FROM kpi"""),
    "kpi_changed_refresh": with_ctes("kpi_of_keys", f"""
        SELECT CAST(zone_id AS INTEGER) AS zone_id, hour_ts, CAST(trips AS INTEGER) AS trips,
               CAST(unique_vehicles AS INTEGER) AS unique_vehicles, {MART_DECIMALS} FROM kpi_of_keys"""),
    "kpi_incremental": with_ctes("kpi", """
        SELECT * FROM kpi WHERE hour_ts >= TIMESTAMP '2025-01-06 12:00:00' AND hour_ts < TIMESTAMP '2025-01-08 00:00:00'"""),
    "kpi_run_stats": with_ctes("kpi", """
        SELECT count(DISTINCT hour_ts) AS hours_processed, count(DISTINCT zone_id) AS zones_affected
        FROM kpi WHERE hour_ts >= TIMESTAMP '2025-01-06 12:00:00' AND hour_ts < TIMESTAMP '2025-01-08 00:00:00'"""),
    "kpi_backfill": with_ctes("kpi", """
        SELECT * FROM kpi WHERE hour_ts >= TIMESTAMP '2025-01-03 00:00:00' AND hour_ts < TIMESTAMP '2025-01-06 00:00:00'"""),
    "kpi_status": with_ctes("kpi", """
        SELECT count(*) AS kpi_count, min(hour_ts) AS first_hour, max(hour_ts) AS last_hour FROM kpi"""),
    "latest_kpis": with_ctes("kpi", "SELECT * FROM kpi ORDER BY hour_ts DESC, trips DESC, zone_id LIMIT 10"),
    "latest_kpi_rows": with_ctes("kpi", "SELECT * FROM kpi ORDER BY hour_ts DESC, zone_id LIMIT 20"),
    "trip_report": with_ctes("stg", f"""
        SELECT count(*) AS total_trips, count(DISTINCT pu_zone_id) AS pickup_zones,
               count(DISTINCT do_zone_id) AS dropoff_zones, {favg('fare_amount')} AS avg_fare,
               {favg('tip_amount')} AS avg_tip, {favg('total_amount')} AS avg_total,
               min(pickup_ts) AS earliest_trip, max(pickup_ts) AS latest_trip FROM stg"""),
    "kpi_report": with_ctes("kpi", f"""
        SELECT count(*) AS total_kpis, count(DISTINCT zone_id) AS zones_with_kpis, {favg('trips')} AS avg_trips_per_hour,
               {favg('avg_fare')} AS avg_fare_per_hour, {favg('avg_tip')} AS avg_tip_per_hour FROM kpi"""),
    "zone_report": with_ctes("zone", """
        SELECT count(*) AS total_zones, count(DISTINCT borough) AS boroughs,
               count(DISTINCT service_zone) AS service_zones FROM zone"""),
    "top_zones": with_ctes("stg zone", f"""
        SELECT zone_id, zone_name, borough, count(*) AS trip_count, {favg('fare_amount')} AS avg_fare
        FROM stg JOIN zone ON pu_zone_id = zone_id GROUP BY 1, 2, 3 ORDER BY trip_count DESC, zone_id LIMIT 10"""),
    "top_zones_mart": with_ctes("kpi zone", f"""
        SELECT zone_name, borough, CAST(sum(trips) AS BIGINT) AS total_trips, {favg('avg_fare')} AS avg_fare,
               {favg('avg_tip')} AS avg_tip
        FROM kpi JOIN zone USING (zone_id) GROUP BY 1, 2 ORDER BY total_trips DESC, zone_name, borough LIMIT 10"""),
    "revenue_stats": with_ctes("stg", f"""
        SELECT count(*) AS trips, {fsum('total_amount')} AS total_revenue, {favg('total_amount')} AS avg_total
        FROM stg WHERE total_amount IS NOT NULL"""),
    "reconcile_mart": with_ctes("kpi", """
        SELECT count(*) AS kpi_records, count(DISTINCT zone_id) AS zones_covered, min(hour_ts) AS first_hour,
               max(hour_ts) AS last_hour, CAST(sum(trips) AS BIGINT) AS total_trips_aggregated FROM kpi"""),
    "peak_hours_mart": with_ctes("kpi", f"""
        SELECT CAST(hour(hour_ts) AS INTEGER) AS hour_of_day, CAST(sum(trips) AS BIGINT) AS total_trips,
               {favg('avg_fare')} AS avg_fare, {favg('pct_card')} AS pct_card FROM kpi GROUP BY 1"""),
    "throughput_by_hour": with_ctes("stg", """
        SELECT date_trunc('hour', pickup_ts) AS hour_bucket, count(*) AS trips FROM stg
        GROUP BY 1 ORDER BY 1 DESC LIMIT 48"""),
    "payment_mix": with_ctes("stg", f"""
        SELECT payment_type, count(*) AS trips, {pct('count(*)', '(SELECT count(*) FROM stg)')} AS pct,
               coalesce(payment_type = 1, false) AS is_card FROM stg GROUP BY payment_type"""),
    "card_share": with_ctes("stg", f"SELECT {pct(count_if('payment_type = 1'), 'count(*)')} AS pct_card FROM stg"),
    "payment_labels": with_ctes("raw", f"""
        SELECT payment_type, CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
                   WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
                   ELSE 'Type ' || payment_type END AS label,
               count(*) AS trips, {pct('count(*)', '(SELECT count(*) FROM raw)')} AS pct
        FROM raw WHERE payment_type IS NOT NULL GROUP BY payment_type"""),
    "duplicate_keys": with_ctes("raw", """
        SELECT row_offset, count(*) AS copies FROM raw GROUP BY 1 HAVING count(*) > 1"""),
    "duplicate_sources": with_ctes("stg", """
        SELECT vendor_id, pickup_ts, pu_zone_id, count(*) AS copies FROM stg GROUP BY ALL HAVING count(*) > 1"""),
    "key_collisions": with_ctes("record", f"""
        SELECT count(*) AS total, count(DISTINCT trip_key) AS distinct_keys,
               count(*) - count(DISTINCT trip_key) AS collisions,
               {pct('count(*) - count(DISTINCT trip_key)', 'count(*)')} AS collision_pct FROM record"""),
    "recent_trips": with_ctes("stg", f"""
        SELECT count(*) AS total_trips, {count_if("pickup_ts > TIMESTAMP '2025-01-14 11:00:00'")} AS recent_trips,
               count(*) - {count_if("pickup_ts > TIMESTAMP '2025-01-14 11:00:00'")} AS older_trips,
               {pct(count_if("pickup_ts > TIMESTAMP '2025-01-14 11:00:00'"), 'count(*)')} AS recent_pct FROM stg"""),
    "latest_trips": with_ctes("uniq", "SELECT * FROM uniq ORDER BY pickup_ts DESC, trip_key LIMIT 10"),
    "sample_rows": with_ctes("curated", f"""
        SELECT pickup_ts, dropoff_ts, pu_zone_id, do_zone_id, distance_km, duration_min, avg_speed_kmh, fare_amount,
               total_amount FROM (SELECT * FROM curated ORDER BY {CURATED_COLUMNS} LIMIT 20)"""),
    "revenue_by_zone": with_ctes("stg", f"""
        SELECT pu_zone_id AS zone_id, {fsum('total_amount')} AS revenue, count(*) AS visits FROM stg GROUP BY 1"""),
    "trips_by_hour": with_ctes("raw", """
        WITH h AS (SELECT CAST(hour(pickup_ts) AS INTEGER) AS hour, count(*) AS trips FROM raw GROUP BY 1)
        SELECT hour, trips, hour = (SELECT hour FROM h ORDER BY trips DESC, hour LIMIT 1) AS is_peak,
               hour = (SELECT hour FROM h ORDER BY trips, hour LIMIT 1) AS is_slowest FROM h"""),
    "trips_by_weekday": with_ctes("raw", """
        SELECT CAST(isodow(pickup_ts) - 1 AS INTEGER) AS day_number, dayname(pickup_ts) AS day_name, count(*) AS trips
        FROM raw GROUP BY 1, 2"""),
    "dow_hour_matrix": with_ctes("curated", """
        SELECT CAST(isodow(pickup_ts) - 1 AS INTEGER) AS day_number, dayname(pickup_ts) AS day_name, """ + ", ".join(
            f"count(CASE WHEN hour(pickup_ts) = {h} THEN 1 END) AS h{h:02d}" for h in range(24)
        ) + " FROM curated GROUP BY 1, 2"),
    "daily_volume": with_ctes("curated", """
        SELECT strftime(pickup_ts, '%Y-%m-%d') AS day, count(*) AS trips FROM curated GROUP BY 1"""),
    "fare_speed_by_hour": with_ctes("curated", f"""
        SELECT CAST(hour(pickup_ts) AS INTEGER) AS hour, {favg('fare_amount')} AS avg_fare,
               {favg('avg_speed_kmh')} AS avg_speed_kmh FROM curated GROUP BY 1"""),
    "value_counts": with_ctes("curated", _value_counts(
        {c: c for c in ("payment_type", "passenger_count", "pu_zone_id")}, "curated")),
    "top_locations": with_ctes("raw", f"""
        SELECT * FROM ({_value_counts({'PULocationID': 'pu_zone_id'}, 'raw')} ORDER BY row_count DESC, value LIMIT 10)
        UNION ALL
        SELECT * FROM ({_value_counts({'DOLocationID': 'do_zone_id'}, 'raw')} ORDER BY row_count DESC, value LIMIT 10)"""),
    # ranks and interpolation spelled out: quantile_cont differs in the last bit
    "quantiles": with_ctes("curated", f"""
        WITH lists AS ({' UNION ALL '.join(
            f"SELECT '{m}' AS metric, list_sort(list({m}) FILTER (WHERE {m} IS NOT NULL)) AS l FROM curated"
            for m in _KEY_METRICS)}),
        ranks AS (SELECT metric, l, p AS probability, (len(l) - 1) * p AS pos
                  FROM lists, (SELECT unnest([{', '.join(f'CAST({q} AS DOUBLE)' for q in _QUANTILES)}]) AS p))
        SELECT metric, probability,
               l[CAST(floor(pos) AS BIGINT) + 1] * (1 - (pos - floor(pos)))
               + l[CAST(ceil(pos) AS BIGINT) + 1] * (pos - floor(pos)) AS quantile FROM ranks"""),
    "trip_distance_stats": with_ctes("timed", f"""
        WITH {_PLAUSIBLE}, {_SPEEDS} {_stats('trip_distance', 'trip_distance', 'plausible', _MEDIAN)}
        UNION ALL {_stats('trip_duration_min', 'trip_duration_min', 'plausible', _MEDIAN)}
        UNION ALL {_stats('avg_speed_mph', 'avg_speed_mph', 'valid', _MEDIAN)}"""),
    "speed_mph_stats": with_ctes("timed", f"""
        WITH {_PLAUSIBLE},
        mph AS (SELECT trip_distance / (nullif(trip_duration_min, 0) / CAST(60 AS DOUBLE)) AS avg_speed_mph FROM plausible),
        valid AS (SELECT * FROM mph WHERE avg_speed_mph > 0 AND avg_speed_mph < 60)
        {_stats('avg_speed_mph', 'avg_speed_mph', 'valid', _MEDIAN)}"""),
    "fare_stats": with_ctes("raw", f"""
        {_stats('fare_amount', 'fare_amount', '(SELECT * FROM raw WHERE fare_amount > 0)', _MEDIAN)}
        UNION ALL {_stats('total_amount', 'total_amount', 'raw', _MEDIAN)}"""),
    "tip_analysis": with_ctes("raw", f"""
        SELECT {count_if('tip_amount > 0')} AS tipped_trips, {pct(count_if('tip_amount > 0'), 'count(*)')} AS tipped_pct,
               {favg('CASE WHEN tip_amount > 0 THEN tip_amount END')} AS avg_tip,
               {favg('CASE WHEN tip_amount > 0 THEN tip_amount / nullif(fare_amount, 0) * 100 END')} AS avg_tip_pct
        FROM raw"""),
    "passenger_stats": with_ctes("raw", f"""
        SELECT passenger_count, count(*) AS trips, {pct('count(*)', '(SELECT count(*) FROM raw)')} AS pct,
               (SELECT sum(passenger_count) / CAST(count(*) AS DOUBLE) FROM raw WHERE passenger_count > 0) AS avg_passengers
        FROM raw WHERE passenger_count > 0 GROUP BY 1"""),
    "describe_numeric": with_ctes("curated", " UNION ALL ".join(
        _stats(c, c, "curated", {"p25": 0.25, "p50": 0.5, "p75": 0.75}) for c in _NUMERIC)),
    "null_profile": with_ctes("raw", " UNION ALL ".join(
        f"""SELECT '{n}' AS column_name, '{t}' AS data_type, {count_if(f'{c} IS NULL')} AS null_count,
            {pct(count_if(f'{c} IS NULL'), 'count(*)')} AS null_pct FROM raw"""
        for n, t, c in (("VendorID", "int", "vendor_id"), ("passenger_count", "int", "passenger_count"),
                        ("trip_distance", "double", "trip_distance"), ("store_and_fwd_flag", "string", "store_and_fwd_flag"),
                        ("congestion_surcharge", "double", "congestion_surcharge"),
                        ("total_amount", "double", "total_amount"), ("extra", "double", "NULL")))),
    "overview": with_ctes("curated", f"""
        SELECT count(*) AS row_count, {len(CURATED_COLUMNS.split(','))} AS column_count, min(pickup_ts) AS first_pickup,
               max(pickup_ts) AS last_pickup,
               CAST(floor({seconds('min(pickup_ts)', 'max(pickup_ts)')} / 86400) AS BIGINT) AS span_days, """ + ", ".join(
            f"{favg(c)} AS avg_{c}" for c in (*_KEY_METRICS, "tip_amount")) + " FROM curated"),
    "month_summary": with_ctes("curated", f"""
        SELECT strftime(pickup_ts, '%Y-%m') AS month, {_MONTHS} FROM curated GROUP BY 1
        UNION ALL SELECT 'TOTAL', {_MONTHS} FROM curated"""),
    "histograms": with_ctes("curated", _HISTOGRAMS),
}

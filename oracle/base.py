"""SQL building blocks: the tables the queries work on, as common table expressions."""

from __future__ import annotations

SALT = "meterline"
AS_OF = "TIMESTAMP '2025-02-01 00:00:00'"
REQUIRED_MASK = 19


def fsum(x: str) -> str:
    """Sum in whole millionths, as double."""
    return f"(CAST(sum(CAST(floor(({x}) * 1e6 + 0.5) AS BIGINT)) AS DOUBLE) / 1e6)"


def favg(x: str) -> str:
    return f"({fsum(x)} / nullif(count({x}), 0))"


# the mart's types, as numbers
MART_DECIMALS = ", ".join(
    f"CAST(CAST({c} AS DECIMAL({p}, 2)) AS DOUBLE) AS {c}" for c, p in {
        "avg_fare": 10, "avg_tip": 10, "avg_speed_kmh": 8, "avg_distance_km": 8, "avg_duration_min": 8, "pct_card": 5}.items())


def pct(part: str, whole: str) -> str:
    return f"(1e2 * ({part}) / nullif({whole}, 0))"


def count_if(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


def iso(ts: str) -> str:
    return (
        f"(CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END)"
    )


def seconds(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 1e6)"


def k() -> str:
    return "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def failed(rules: list[tuple[str, str]]) -> str:
    """Comma-separated names of the rules that do not hold; conditions may be NULL."""
    parts = ", ".join(f"CASE WHEN coalesce({ok}, false) THEN NULL ELSE '{name}' END" for name, ok in rules)
    return f"concat_ws(',', {parts})"


def between(c: str, lo: int, hi: int) -> str:
    return f"({c} BETWEEN {lo} AND {hi})"


def opt(c: str, cond: str) -> str:
    return f"({c} IS NULL OR {cond})"


UPDATE_RULES = [
    ("passenger_count", opt("passenger_count", between("passenger_count", 0, 9))),
    ("trip_distance", opt("trip_distance", "trip_distance >= 0")),
    ("fare_amount", opt("fare_amount", "fare_amount >= 0")),
    ("tip_amount", opt("tip_amount", "tip_amount >= 0")),
    ("total_amount", opt("total_amount", "total_amount >= 0")),
    ("payment_type", opt("payment_type", between("payment_type", 1, 6))),
]
CREATE_RULES = [
    ("vendor_id", between("vendor_id", 1, 6)),
    ("pickup_ts", "pickup_ts IS NOT NULL"),
    ("dropoff_ts", "dropoff_ts > pickup_ts"),
    ("pu_zone_id", between("pu_zone_id", 1, 265)),
    ("do_zone_id", between("do_zone_id", 1, 265)),
    *UPDATE_RULES,
    ("vehicle_id_h", "length(vehicle_id_h) <= 16"),
]
COMPLETE_RULES = [
    ("trip_key", "length(trip_key) <= 64"),
    *[(n, opt("total_amount", "total_amount BETWEEN 0 AND 1000") if n == "total_amount" else c) for n, c in CREATE_RULES],
]

CURATED_COLUMNS = (
    "row_offset, vendor_id, pickup_ts, dropoff_ts, passenger_count, trip_distance, rate_code, store_and_fwd_flag, "
    "pu_zone_id, do_zone_id, payment_type, fare_amount, tip_amount, tolls_amount, total_amount, "
    "congestion_surcharge, airport_fee, distance_km, duration_min, avg_speed_kmh"
)
STAGED_COLUMNS = (
    "trip_key, vendor_id, pickup_ts, dropoff_ts, pu_zone_id, do_zone_id, passenger_count, trip_distance, "
    "fare_amount, tip_amount, total_amount, payment_type, vehicle_id_h, source, created_at, updated_at"
)
EVENT_TYPES = ("trip_started", "trip_ended", "payment_processed", "zone_entered", "zone_exited")

_PICKUP = (
    "(TIMESTAMP '2025-01-01 00:00:00' + to_seconds(CAST(l_orderkey % 14 * 86400 + l_partkey * 37 % 86400 AS INTEGER)))"
)
_FARE = "(l_extendedprice / CAST(1000 AS DOUBLE))"
_TOTAL = f"({_FARE} * (CAST(1 AS DOUBLE) + l_discount + l_tax))"
_KIND = """CASE event_type WHEN 'click' THEN 'trip_started' WHEN 'view' THEN 'trip_ended'
    WHEN 'purchase' THEN 'payment_processed' WHEN 'signup' THEN 'zone_entered'
    WHEN 'error' THEN 'zone_exited' ELSE event_type END"""

_KM = "(trip_distance * CAST(1.60934 AS DOUBLE))"

# name -> (tables it needs, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": ((), f"""
        SELECT l_orderkey * 10 + l_linenumber AS row_offset,
               l_linenumber AS vendor_id,
               {_PICKUP} AS pickup_ts,
               {_PICKUP} + to_seconds(CAST((l_quantity - 2) * 60 AS INTEGER)) AS dropoff_ts,
               nullif(l_linenumber, 7) AS passenger_count,
               l_extendedprice / CAST(5000 AS DOUBLE) AS trip_distance,
               CAST(l_quantity AS INTEGER) % 6 + 1 AS rate_code,
               CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
               c_nationkey + 1 AS pu_zone_id,
               s_nationkey + 1 AS do_zone_id,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
               {_FARE} AS fare_amount,
               {_FARE} * l_discount AS tip_amount,
               l_tax * CAST(10 AS DOUBLE) AS tolls_amount,
               CASE WHEN l_orderkey % 97 = 0 THEN -{_TOTAL} ELSE {_TOTAL} END AS total_amount,
               nullif(l_tax, CAST(0 AS DOUBLE)) AS congestion_surcharge,
               l_discount * CAST(10 AS DOUBLE) AS airport_fee
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"""),
    "timed": (("raw",), f"""
        SELECT *, {_KM} AS distance_km,
               {seconds('pickup_ts', 'dropoff_ts')} / CAST(60 AS DOUBLE) AS duration_min FROM raw"""),
    "derived": (("timed",), """
        SELECT *, CASE WHEN duration_min <> 0
                       THEN distance_km / (nullif(duration_min, 0) / CAST(60 AS DOUBLE)) END AS avg_speed_kmh FROM timed"""),
    "flagged": (("derived",), """
        SELECT *, CASE WHEN NOT coalesce(pickup_ts < dropoff_ts, false) THEN 'temporal_invalid'
                       WHEN avg_speed_kmh > 200 THEN 'speed_invalid'
                       WHEN NOT coalesce(total_amount >= 0, false) THEN 'negative_amount' END AS reject_reason
        FROM derived"""),
    "curated": (("flagged",), f"SELECT {CURATED_COLUMNS} FROM flagged WHERE reject_reason IS NULL"),
    "keyed_raw": (("raw",), f"""
        SELECT *, sha256('{SALT}|' || vendor_id || '|' || {iso('pickup_ts')} || '|' || pu_zone_id || '|' || row_offset)
                  AS trip_key,
               'veh_' || substr(sha256('{SALT}|vehicle|' || vendor_id || '|' || (row_offset % 5000)), 1, 12)
                  AS vehicle_id_h FROM raw"""),
    "record": (("curated",), f"""
        SELECT *, sha256('{SALT}|' || vendor_id || '|' || {iso('pickup_ts')} || '|' || pu_zone_id || '|' || row_offset)
                  AS trip_key,
               'veh_' || substr(sha256('{SALT}|vehicle|' || vendor_id || '|' || (row_offset % 5000)), 1, 12)
                  AS vehicle_id_h,
               'batch' AS source, {AS_OF} AS created_at, {AS_OF} AS updated_at
        FROM curated WHERE vendor_id IS NOT NULL AND pu_zone_id IS NOT NULL"""),
    "validated": (("record",), f"SELECT *, {failed(COMPLETE_RULES)} AS failed_rules FROM record"),
    "stg": (("validated",), f"SELECT {STAGED_COLUMNS} FROM validated WHERE failed_rules = ''"),
    "zone": ((), """
        SELECT n_nationkey + 1 AS zone_id, r_name AS borough, n_name AS zone_name,
               CASE r_name WHEN 'AMERICA' THEN 'Yellow Zone' WHEN 'EUROPE' THEN 'Airports' ELSE 'Boro Zone' END
                  AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    # copies of a key are reduced to the greatest row, column by column in schema order
    "uniq": (("stg",), f"""
        SELECT {STAGED_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY trip_key ORDER BY
            vendor_id DESC, pickup_ts DESC, dropoff_ts DESC, pu_zone_id DESC, do_zone_id DESC,
            passenger_count DESC NULLS LAST, trip_distance DESC, fare_amount DESC, tip_amount DESC, total_amount DESC,
            payment_type DESC, vehicle_id_h DESC) AS rn FROM stg) WHERE rn = 1"""),
    "ev_raw": ((), f"SELECT *, {k()} AS k, {_KIND} AS kind FROM events"),
    "ev": (("ev_raw",), f"""
        SELECT event_id AS seq_id, ts AS event_ts, k, 'evt-' || event_id AS event_id,
               user_id || '|' || strftime(ts, '%Y-%m-%d') AS trip_key, kind AS event_type,
               {iso('ts')} AS "timestamp", CAST(user_id % 6 + 1 AS INTEGER) AS vendor_id,
               'veh_' || lpad(CAST(user_id % 5000 AS VARCHAR), 12, '0') AS vehicle_id_h, 'stream' AS source,
               CASE WHEN kind = 'trip_started' THEN k + 1 END AS pickup_zone_id,
               CASE WHEN kind = 'trip_started' AND k % 10 <> 9 THEN k % 10 END AS passenger_count,
               CASE WHEN kind = 'trip_ended' THEN k + 1 END AS dropoff_zone_id,
               CASE WHEN kind = 'trip_ended' THEN value END AS trip_distance,
               CASE WHEN kind = 'payment_processed' THEN value END AS fare_amount,
               CASE WHEN kind = 'payment_processed' AND k % 4 <> 0 THEN value / 8 END AS tip_amount,
               CASE WHEN kind = 'payment_processed' THEN value * CAST(1.25 AS DOUBLE) END AS total_amount,
               CASE WHEN kind = 'payment_processed' THEN k % 6 + 1 END AS payment_type,
               CASE WHEN kind IN ('zone_entered', 'zone_exited') THEN k + 1 END AS zone_id
        FROM ev_raw"""),
    # messages as the topic delivers them; a cut-off one has no readable field
    "msg": (("ev",), """
        SELECT * REPLACE (
            CASE WHEN k = 60 THEN NULL WHEN k >= 95 THEN 'driver_break' ELSE event_type END AS event_type,
            CASE WHEN k = 60 OR k < 3 THEN NULL ELSE trip_key END AS trip_key,
            CASE WHEN k = 60 OR k = 51 THEN NULL WHEN k = 50 THEN 'not-a-time' ELSE "timestamp" END AS "timestamp",
            CASE WHEN k = 60 THEN NULL ELSE event_id END AS event_id,
            CASE WHEN k = 60 THEN NULL ELSE vendor_id END AS vendor_id,
            CASE WHEN k = 60 THEN NULL ELSE vehicle_id_h END AS vehicle_id_h,
            CASE WHEN k = 60 THEN NULL ELSE source END AS source,
            CASE WHEN k = 60 THEN NULL ELSE passenger_count END AS passenger_count,
            CASE WHEN k = 60 THEN NULL ELSE pickup_zone_id END AS pickup_zone_id,
            CASE WHEN k = 60 THEN NULL ELSE dropoff_zone_id END AS dropoff_zone_id,
            CASE WHEN k = 60 THEN NULL ELSE trip_distance END AS trip_distance,
            CASE WHEN k = 60 THEN NULL ELSE fare_amount END AS fare_amount,
            CASE WHEN k = 60 THEN NULL ELSE tip_amount END AS tip_amount,
            CASE WHEN k = 60 THEN NULL ELSE total_amount END AS total_amount,
            CASE WHEN k = 60 THEN NULL ELSE payment_type END AS payment_type,
            CASE WHEN k = 60 THEN NULL ELSE zone_id END AS zone_id,
            CASE WHEN k NOT IN (50, 51, 60) THEN event_ts END AS event_ts),
            event_ts AS seq_ts
        FROM ev"""),
    "parsed": (("msg",), """
        SELECT *, CASE WHEN coalesce(event_type, trip_key, event_id, "timestamp") IS NULL THEN 'malformed'
                       WHEN coalesce(event_type NOT IN ('trip_started', 'trip_ended', 'payment_processed',
                                                        'zone_entered', 'zone_exited'), true) THEN 'unknown_type'
                       WHEN event_id IS NULL OR trip_key IS NULL OR vendor_id IS NULL OR vehicle_id_h IS NULL
                            OR "timestamp" IS NULL THEN 'field_missing'
                       WHEN event_ts IS NULL THEN 'bad_timestamp' END AS reject_reason
        FROM msg"""),
    "state": (("ev",), """
        SELECT trip_key,
               CAST(bit_or(CASE event_type WHEN 'trip_started' THEN 1 WHEN 'trip_ended' THEN 2
                    WHEN 'payment_processed' THEN 16 WHEN 'zone_entered' THEN 32 WHEN 'zone_exited' THEN 64
                    ELSE 0 END) AS INTEGER) AS mask
        FROM ev GROUP BY trip_key"""),
    "good": (("parsed",), "SELECT * FROM parsed WHERE reject_reason IS NULL"),
    "good_typed": (("good",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_key, event_type
                                                    ORDER BY event_ts DESC, seq_id DESC) AS rn FROM good) WHERE rn = 1"""),
    "good_newest": (("good",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_key
                                                    ORDER BY event_ts DESC, seq_id DESC) AS rn FROM good) WHERE rn = 1"""),
    # latest event per trip and type
    "typed": (("ev",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_key, event_type
                                                    ORDER BY event_ts DESC, seq_id DESC) AS rn FROM ev) WHERE rn = 1"""),
    "newest": (("ev",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_key
                                                    ORDER BY event_ts DESC, seq_id DESC) AS rn FROM ev) WHERE rn = 1"""),
}
CTES["kpi"] = (("stg",), f"""
        SELECT pu_zone_id AS zone_id, date_trunc('hour', pickup_ts) AS hour_ts, count(*) AS trips,
               {favg('fare_amount')} AS avg_fare, {favg('tip_amount')} AS avg_tip,
               {favg(f"CASE WHEN {seconds('pickup_ts', 'dropoff_ts')} > 0 THEN {_KM} / ({seconds('pickup_ts', 'dropoff_ts')} / CAST(3600 AS DOUBLE)) END")} AS avg_speed_kmh,
               {favg(_KM)} AS avg_distance_km,
               {favg(f"{seconds('pickup_ts', 'dropoff_ts')} / CAST(60 AS DOUBLE)")} AS avg_duration_min,
               {pct("count(CASE WHEN payment_type = 1 THEN 1 END)", 'count(*)')} AS pct_card,
               count(DISTINCT vehicle_id_h) AS unique_vehicles
        FROM stg WHERE pu_zone_id IS NOT NULL GROUP BY 1, 2""")
# the same over trips with one row per key, as the stored table has them
CTES["kpi_of_keys"] = (("uniq",), CTES["kpi"][1].replace("FROM stg WHERE", "FROM uniq WHERE"))


def with_ctes(names: str, body: str) -> str:
    """``body`` behind the named tables and everything they need."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for needed in CTES[name][0]:
                add(needed)
            order.append(name)

    for name in names.split():
        add(name)
    if not order:
        return body
    tables = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    extra = body.lstrip()
    if extra.upper().startswith("WITH "):
        return f"WITH {tables},\n{extra[5:]}"
    return f"WITH {tables}\n{extra}"

"""Table schemas and the fixed values of the trip domain."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# These must equal the published ones for results to match; they are data, not logic.

KM_PER_MILE = 1.60934
MAX_SPEED_KMH = 200.0
DEFAULT_FLEET_SIZE = 5000

# Raw monthly file column -> curated column.
RAW_TO_CURATED = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_ts",
    "tpep_dropoff_datetime": "dropoff_ts",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pu_zone_id",
    "DOLocationID": "do_zone_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
    "cbd_congestion_fee": "cbd_congestion_fee",
}

ZONE_CSV_TO_ZONE = {
    "LocationID": "zone_id",
    "Borough": "borough",
    "Zone": "zone_name",
    "service_zone": "service_zone",
}

PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# Stream event type -> bit position.
EVENT_BITS = {
    "trip_started": 0,
    "trip_ended": 1,
    "passenger_picked_up": 2,
    "passenger_dropped_off": 3,
    "payment_processed": 4,
    "zone_entered": 5,
    "zone_exited": 6,
}

PARSED_EVENT_TYPES = ("trip_started", "trip_ended", "payment_processed", "zone_entered", "zone_exited")
#: A control message: what is known of the trip up to its time is forgotten.
TRIP_DELETED = "trip_deleted"
REQUIRED_EVENT_TYPES = ("trip_started", "trip_ended", "payment_processed")
CONTRACT_EVENT_TYPES = ("IDENTITY", "PASSENGERS", "FARE", "DROP", "TIP")

# (zone_id, borough, zone_name, service_zone) used when no zone file is given.
FALLBACK_ZONES = (
    (1, "Manhattan", "Central Park", "Yellow Zone"),
    (2, "Manhattan", "Times Square", "Yellow Zone"),
    (3, "Brooklyn", "Brooklyn Heights", "Boro Zone"),
    (4, "Queens", "LaGuardia Airport", "Airport"),
    (5, "Queens", "JFK Airport", "Airport"),
)

LATENCY_BUCKETS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)
BATCH_SIZE_BUCKETS = (1, 5, 10, 25, 50, 100, 250, 500, 1000)

STATE_TTL = "6 hours"

# -------------------------------------------------------------------- schemas


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_INT, _LONG, _DBL, _STR = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_TS = T.TimestampNTZType()

RAW_TRIP = _struct(
    VendorID=_INT,
    tpep_pickup_datetime=_TS,
    tpep_dropoff_datetime=_TS,
    passenger_count=_INT,
    trip_distance=_DBL,
    RatecodeID=_INT,
    store_and_fwd_flag=_STR,
    PULocationID=_INT,
    DOLocationID=_INT,
    payment_type=_INT,
    fare_amount=_DBL,
    extra=_DBL,
    mta_tax=_DBL,
    tip_amount=_DBL,
    tolls_amount=_DBL,
    improvement_surcharge=_DBL,
    total_amount=_DBL,
    congestion_surcharge=_DBL,
    Airport_fee=_DBL,
    cbd_congestion_fee=_DBL,
)

ZONE = _struct(zone_id=_INT, borough=_STR, zone_name=_STR, service_zone=_STR)

COMPLETE_TRIP = _struct(
    trip_key=_STR,
    vendor_id=_INT,
    pickup_ts=_TS,
    dropoff_ts=_TS,
    pu_zone_id=_INT,
    do_zone_id=_INT,
    passenger_count=_INT,
    trip_distance=_DBL,
    fare_amount=_DBL,
    tip_amount=_DBL,
    total_amount=_DBL,
    payment_type=_INT,
    vehicle_id_h=_STR,
    source=_STR,
    created_at=_TS,
    updated_at=_TS,
)

ZONE_HOURLY_KPIS = _struct(
    zone_id=_INT,
    hour_ts=_TS,
    trips=_INT,
    avg_fare=T.DecimalType(10, 2),
    avg_tip=T.DecimalType(10, 2),
    avg_speed_kmh=T.DecimalType(8, 2),
    avg_distance_km=T.DecimalType(8, 2),
    avg_duration_min=T.DecimalType(8, 2),
    pct_card=T.DecimalType(5, 2),
    outlier_rate=T.DecimalType(5, 2),
    unique_vehicles=_INT,
    created_at=_TS,
    updated_at=_TS,
)

# Union of the fields of all stream event types; fields of other types stay NULL.
TRIP_EVENT = _struct(
    event_id=_STR,
    trip_key=_STR,
    event_type=_STR,
    timestamp=_STR,
    vendor_id=_INT,
    vehicle_id_h=_STR,
    source=_STR,
    pickup_zone_id=_INT,
    passenger_count=_INT,
    dropoff_zone_id=_INT,
    trip_distance=_DBL,
    trip_duration_minutes=_DBL,
    fare_amount=_DBL,
    tip_amount=_DBL,
    total_amount=_DBL,
    payment_type=_INT,
    zone_id=_INT,
    zone_name=_STR,
    borough=_STR,
)

CONTRACT_PAYLOAD = _struct(
    vendor_id=_INT,
    vehicle_id_h=_STR,
    pickup_ts=_TS,
    dropoff_ts=_TS,
    pu_zone_id=_INT,
    do_zone_id=_INT,
    rate_code=_INT,
    store_and_fwd_flag=_STR,
    passenger_count=_INT,
    fare_amount=_DBL,
    tip_amount=_DBL,
    total_amount=_DBL,
    payment_type=_INT,
    tolls_amount=_DBL,
    congestion_surcharge=_DBL,
    airport_fee=_DBL,
    trip_distance=_DBL,
    distance_km=_DBL,
    duration_min=_DBL,
    avg_speed_kmh=_DBL,
)

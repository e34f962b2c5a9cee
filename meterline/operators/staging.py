"""Curated trips to staging rows: hashed keys, typed record, zone references, lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.functions import trips
from meterline.functions.hashing import trip_key, vehicle_id
from meterline.operators.validation import complete_rules, failed_rules, only_valid
from meterline.schemas import COMPLETE_TRIP, DEFAULT_FLEET_SIZE

_INTS = ("vendor_id", "pu_zone_id", "do_zone_id", "passenger_count", "rate_code", "payment_type")
_DOUBLES = (
    "trip_distance", "fare_amount", "total_amount", "tip_amount", "tolls_amount",
    "congestion_surcharge", "airport_fee", "distance_km", "duration_min", "avg_speed_kmh",
)


def timestamp_literal(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def key_reject_reason() -> Column:
    """Why a row cannot be keyed, NULL when it can."""
    return F.when(F.col("vendor_id").isNull(), "vendor_missing").when(F.col("pu_zone_id").isNull(), "zone_missing")


def keyable(df: DataFrame) -> DataFrame:
    """Rows with every part of the key; hashing others would give no key at all."""
    return df.where(F.col("vendor_id").isNotNull() & F.col("pu_zone_id").isNotNull())


def with_trip_keys(df: DataFrame, salt: str, fleet_size: int = DEFAULT_FLEET_SIZE) -> DataFrame:
    """Add ``trip_key`` and ``vehicle_id_h`` from the row position carried by the source."""
    return df.withColumns({
        "trip_key": trip_key(salt, F.col("vendor_id"), F.col("pickup_ts"), F.col("pu_zone_id"), F.col("row_offset")),
        "vehicle_id_h": vehicle_id(salt, F.col("vendor_id"), F.col("row_offset"), fleet_size),
    })


def to_complete_trip(curated: DataFrame, salt: str, source: str, as_of: dt.datetime) -> DataFrame:
    """Typed trip record per keyable curated row; missing values stay NULL."""
    return _typed(with_trip_keys(keyable(curated), salt), source, as_of)


def _typed(keyed: DataFrame, source: str, as_of: dt.datetime, *also: str) -> DataFrame:
    now = timestamp_literal(as_of)
    return keyed.select(
        "trip_key", "vehicle_id_h", "pickup_ts", "dropoff_ts", "store_and_fwd_flag",
        *[F.col(c).cast("int").alias(c) for c in _INTS],
        *[F.col(c).cast("double").alias(c) for c in _DOUBLES],
        F.lit(source).alias("source"), now.alias("created_at"), now.alias("updated_at"), *also,
    )


def judged_trips(curated: DataFrame, zones: DataFrame, salt: str, source: str, as_of: dt.datetime) -> DataFrame:
    """Every curated row as staging row with ``reject_reason``: no key, first broken rule, or unknown zone; NULL for a good one."""
    keyed = with_trip_keys(curated, salt).withColumn("key_reason", key_reject_reason())
    judged = judge(_typed(keyed, source, as_of, "key_reason", "row_offset"), zones)
    reason = F.coalesce("key_reason", "reject_reason")
    return judged.select(*COMPLETE_TRIP.names, "row_offset", reason.alias("reject_reason"))


def judge(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Staging rows with ``reject_reason``: the first broken rule, or the side whose zone is unknown."""
    rules = {name: ok for name, ok in complete_rules().items() if name not in ("trip_key", "vehicle_id_h")}
    broken = F.concat(F.lit("rule:"), F.get(failed_rules(rules), F.lit(0)))
    marked = _with_known_zones(rows.withColumn("rule_reason", broken), zones)
    return marked.withColumn("reject_reason", F.coalesce("rule_reason", zone_reject_reason())).drop("rule_reason", "pu_known", "do_known")


def stage_trips(curated: DataFrame, salt: str, source: str, as_of: dt.datetime) -> DataFrame:
    """Valid staging rows of a curated table.

    The two hashed ids have the right length by construction, so filtering on them would only
    compute each hash twice.
    """
    rules = {name: ok for name, ok in complete_rules().items() if name not in ("trip_key", "vehicle_id_h")}
    return only_valid(to_complete_trip(curated, salt, source, as_of), rules).select(*COMPLETE_TRIP.names)


def dense_row_offsets(df: DataFrame, *month: str) -> DataFrame:
    """Renumber ``row_offset`` from 0 per month, as positions in a rewritten file would be.

    Rows are counted per block of original positions; only the block counts are ordered and
    summed, and the numbering inside a block touches a bounded number of rows.
    """
    block = F.floor(F.col("row_offset") / 100_000)
    rows = df.withColumn("_block", block)
    counts = rows.groupBy(*month, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*month).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*month, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*month, "_block").orderBy("row_offset")
    numbered = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, [*month, "_block"])
        .withColumn("row_offset", F.col("_start") + F.col("_rank"))
        .select(*df.columns)
    )


def trip_properties(df: DataFrame) -> DataFrame:
    return df.select(
        "trip_key",
        trips.duration_min(F.col("pickup_ts"), F.col("dropoff_ts")).alias("trip_duration_minutes"),
        trips.has_tip(F.col("tip_amount")).alias("has_tip"),
        trips.is_complete(*[F.col(c) for c in (
            "vendor_id", "pickup_ts", "dropoff_ts", "pu_zone_id", "do_zone_id", "trip_key", "vehicle_id_h",
        )]).alias("is_complete"),
    )


def zone_orphans(trips_df: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose zone is not in the dimension, per side.

    Trips are reduced to distinct zone pairs with counts before meeting the dimension.
    """
    pairs = trips_df.groupBy("pu_zone_id", "do_zone_id").agg(F.count("*").alias("n"))
    return _with_known_zones(pairs, zones).agg(
        F.coalesce(F.sum(F.when(F.col("pu_known").isNull(), F.col("n"))), F.lit(0)).alias("invalid_pu_zone_refs"),
        F.coalesce(F.sum(F.when(F.col("do_known").isNull(), F.col("n"))), F.lit(0)).alias("invalid_do_zone_refs"),
    )


def enforce_zones(trips_df: DataFrame, zones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trips whose two zones exist, and the rejected rest with the failed side."""
    marked = with_zone_reason(trips_df, zones)
    return (
        marked.where("reject_reason is null").drop("reject_reason"),
        marked.where("reject_reason is not null"),
    )


def with_zone_reason(trips_df: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with ``reject_reason``: the side whose zone is unknown, NULL when both are known."""
    marked = _with_known_zones(trips_df, zones)
    return marked.withColumn("reject_reason", zone_reject_reason()).drop("pu_known", "do_known")


def zone_reject_reason() -> Column:
    return F.when(F.col("pu_known").isNull(), "pu_zone_unknown").when(F.col("do_known").isNull(), "do_zone_unknown")


def _with_known_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    pu = zones.select(F.col("zone_id").alias("pu_zone_id"), F.lit(True).alias("pu_known"))
    do = zones.select(F.col("zone_id").alias("do_zone_id"), F.lit(True).alias("do_known"))
    return df.join(pu, "pu_zone_id", "left").join(do, "do_zone_id", "left")


def trips_with_zones(trips_df: DataFrame, zones: DataFrame) -> DataFrame:
    """Both roles of the zone dimension beside each trip."""
    def role(prefix: str) -> DataFrame:
        return zones.select(
            F.col("zone_id").alias(f"{prefix}_zone_id"), F.col("borough").alias(f"{prefix}_borough"),
            F.col("zone_name").alias(f"{prefix}_zone_name"), F.col("service_zone").alias(f"{prefix}_service_zone"),
        )
    return trips_df.join(role("pu"), "pu_zone_id").join(role("do"), "do_zone_id")


def trip_by_key(trips_df: DataFrame, key: str | Column) -> DataFrame:
    return trips_df.where(F.col("trip_key") == key)


def first_trips(trips_df: DataFrame, n: int) -> DataFrame:
    return trips_df.orderBy("pickup_ts", "trip_key").limit(n)


def latest_trips(trips_df: DataFrame, n: int = 10) -> DataFrame:
    return trips_df.orderBy(F.desc("pickup_ts"), "trip_key").limit(n)


def recent_share(trips_df: DataFrame, as_of: Column, column: str = "created_at") -> DataFrame:
    """Trips of the hour before ``as_of`` beside all others."""
    recent = F.count(F.when(F.col(column) > F.timestamp_add("HOUR", F.lit(-1), as_of), F.lit(1)))
    return trips_df.agg(
        F.count("*").alias("total_trips"), recent.alias("recent_trips"),
        (F.count("*") - recent).alias("older_trips"),
        (F.lit(100.0) * recent / F.nullif(F.count("*"), F.lit(0))).alias("recent_pct"),
    )

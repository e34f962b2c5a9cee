"""Zone-hour KPIs from stored sums per vehicle, kept up to date by the changes of the trip table.

The ledger has one row per zone, hour and vehicle: counts and sums in whole millionths. They can be taken back, so a corrected
trip is its old row subtracted and its new row added, and an hour is never computed again from all its trips. The vehicles of
an hour are the ledger rows that still have trips, which is an exact distinct count that can also fall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterline.functions.numeric import MICROS, count_if, is_finite, percent, whole_micros
from meterline.functions.trips import distance_km, hour_start, seconds_between
from meterline.operators.kpis import CARD

SIGN = "change_sign"
HOUR = ("zone_id", "hour_ts")
KEYS = (*HOUR, "vehicle")
#: Stands for trips without a vehicle; real ones carry a prefix.
NO_VEHICLE = "-"
_TOTAL = T.DecimalType(38, 0)
AVERAGES = ("avg_fare", "avg_tip", "avg_speed_kmh", "avg_distance_km", "avg_duration_min")
COUNTS = ("trips", "card", *[f"{m}_{part}" for m in AVERAGES for part in ("n", "bad")])
SUMS = tuple(f"{m}_sum" for m in AVERAGES)

LEDGER = T.StructType([
    T.StructField("zone_id", T.IntegerType()), T.StructField("hour_ts", T.TimestampNTZType()), T.StructField("vehicle", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in COUNTS], *[T.StructField(c, _TOTAL) for c in SUMS],
])


def _measures() -> dict[str, Column]:
    km, seconds = distance_km(F.col("trip_distance")), seconds_between(F.col("pickup_ts"), F.col("dropoff_ts"))
    kmh = F.when(seconds > 0, km / (seconds / F.lit(3600.0)))
    return dict(zip(AVERAGES, (F.col("fare_amount"), F.col("tip_amount"), kmh, km, seconds / F.lit(60.0)), strict=True))


def contributions(changes: DataFrame) -> DataFrame:
    """What trips with a ``change_sign`` of 1 or -1 add to the ledger; rows that change nothing are left out."""
    sign = F.col(SIGN)
    rows = changes.where(F.col("pu_zone_id").isNotNull() & F.col("pickup_ts").isNotNull())
    parts = {"trips": F.sum(sign.cast("long")), "card": F.sum(F.when(F.col("payment_type") == CARD, sign).otherwise(0).cast("long"))}
    for name, value in _measures().items():
        value = value.cast("double")
        parts[f"{name}_n"] = F.sum(F.when(value.isNotNull(), sign).otherwise(0).cast("long"))
        parts[f"{name}_bad"] = F.sum(F.when(is_finite(value), 0).when(value.isNotNull(), sign).otherwise(0).cast("long"))
        parts[f"{name}_sum"] = F.sum(F.coalesce(whole_micros(value), F.lit(0)) * sign)
    vehicle = F.coalesce(F.concat(F.lit("v"), "vehicle_id_h"), F.lit(NO_VEHICLE))
    summed = rows.groupBy(F.col("pu_zone_id").alias("zone_id"), hour_start(F.col("pickup_ts")).alias("hour_ts"), vehicle.alias("vehicle")).agg(
        *[c.alias(n) for n, c in parts.items()])
    moved = F.greatest(*[F.abs(F.col(c)) for c in COUNTS]) > 0
    for c in SUMS:
        moved = moved | (F.col(c) != 0)
    return _typed(summed.where(moved))


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER.fields])


def add(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """The new ledger rows of the keys in ``delta``; ``stored`` holds at least the rows with these keys."""
    keys = list(KEYS)
    both = stored.join(delta.select(*keys), keys, "left_semi").unionByName(delta)
    return _typed(both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*COUNTS, *SUMS)]))


def ledger_kpis(ledger: DataFrame) -> DataFrame:
    """The same rows as ``kpis.zone_hourly_kpis`` over the trips behind the ledger."""
    rows = ledger.where("trips > 0")
    averages = [
        F.when(F.sum(f"{m}_bad") == 0, F.sum(f"{m}_sum").cast("double") / F.lit(MICROS) / F.nullif(F.sum(f"{m}_n"), F.lit(0))).alias(m)
        for m in AVERAGES
    ]
    return rows.groupBy(*HOUR).agg(
        F.sum("trips").alias("trips"), *averages, percent(F.sum("card"), F.sum("trips")).alias("pct_card"),
        count_if(F.col("vehicle") != NO_VEHICLE).alias("unique_vehicles"),
    )

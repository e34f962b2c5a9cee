"""Zone-hour KPIs: full, incremental and backfill ranges, mart rows, run statistics."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.numeric import count_if, fixed_avg, percent
from meterline.functions.trips import distance_km, hour_start, seconds_between
from meterline.operators.staging import timestamp_literal
from meterline.schemas import ZONE_HOURLY_KPIS

CARD = 1
#: What KPIs read of a trip.
TRIP_COLUMNS = (
    "pu_zone_id", "pickup_ts", "dropoff_ts", "trip_distance", "fare_amount", "tip_amount", "payment_type", "vehicle_id_h",
)


@dataclass(frozen=True)
class TimeRange:
    """Half-open range of pickup times."""

    start: dt.datetime
    end: dt.datetime

    def contains(self, column: str) -> Column:
        return (F.col(column) >= timestamp_literal(self.start)) & (F.col(column) < timestamp_literal(self.end))


def _midnight(moment: dt.datetime) -> dt.datetime:
    return moment.replace(hour=0, minute=0, second=0, microsecond=0)


def incremental_range(target: dt.datetime, lookback_hours: int = 24) -> TimeRange:
    day = _midnight(target)
    return TimeRange(day - dt.timedelta(hours=lookback_hours), day + dt.timedelta(days=1))


def backfill_range(start: dt.datetime, end: dt.datetime) -> TimeRange:
    """Whole days from the first to the last date, the last microsecond included."""
    return TimeRange(_midnight(start), _midnight(end) + dt.timedelta(days=1))


def zone_hourly_kpis(trips: DataFrame, within: TimeRange | None = None) -> DataFrame:
    """KPIs per pickup zone and hour.

    Vehicles are counted beside the other measures, not with them: a distinct count in the same
    aggregate would send every sum through a shuffle by zone, hour and vehicle, about one row per
    trip. So the measures are combined per zone and hour where they are read, and only distinct
    (zone, hour, vehicle) keys are shuffled, which also spreads a busy zone over many tasks. Both
    sides end up partitioned by zone and hour and join without a further shuffle.
    """
    rows = trips.where(F.col("pu_zone_id").isNotNull())
    if within is not None:
        rows = rows.where(within.contains("pickup_ts"))
    pickup, dropoff = F.col("pickup_ts"), F.col("dropoff_ts")
    km, seconds = distance_km(F.col("trip_distance")), seconds_between(pickup, dropoff)
    kmh = F.when(seconds > 0, km / (seconds / F.lit(3600.0)))
    keys = {"zone_id": F.col("pu_zone_id"), "hour_ts": hour_start(pickup)}
    measures = rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.count("*").alias("trips"),
        fixed_avg(F.col("fare_amount")).alias("avg_fare"),
        fixed_avg(F.col("tip_amount")).alias("avg_tip"),
        fixed_avg(kmh).alias("avg_speed_kmh"),
        fixed_avg(km).alias("avg_distance_km"),
        fixed_avg(seconds / F.lit(60.0)).alias("avg_duration_min"),
        percent(count_if(F.col("payment_type") == CARD), F.count("*")).alias("pct_card"),
    )
    vehicles = (
        rows.select(*[c.alias(n) for n, c in keys.items()], "vehicle_id_h").distinct()
        .groupBy(*keys).agg(F.count("vehicle_id_h").alias("unique_vehicles"))
    )
    return measures.join(vehicles, list(keys))


def kpi_full_refresh(trips: DataFrame) -> DataFrame:
    """KPIs of every hour with trips; the range of the data needs no pass of its own."""
    return zone_hourly_kpis(trips)


def kpi_incremental(trips: DataFrame, target: dt.datetime, lookback_hours: int = 24) -> DataFrame:
    return zone_hourly_kpis(trips, incremental_range(target, lookback_hours))


def kpi_backfill(trips: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return zone_hourly_kpis(trips, backfill_range(start, end))


def mart_rows(kpis: DataFrame, as_of: dt.datetime) -> DataFrame:
    """KPIs in the mart's types: rounded decimals, audit times, no outlier rate."""
    extra = {"outlier_rate": F.lit(None), "created_at": timestamp_literal(as_of), "updated_at": timestamp_literal(as_of)}
    return kpis.withColumns(extra).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ZONE_HOURLY_KPIS.fields]
    )


def kpi_run_stats(kpis: DataFrame) -> DataFrame:
    """Distinct hours and zones of a run; zeros when it produced nothing."""
    return kpis.agg(
        F.count_distinct("hour_ts").alias("hours_processed"), F.count_distinct("zone_id").alias("zones_affected"),
    )


def kpi_status(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.count("*").alias("kpi_count"), F.min("hour_ts").alias("first_hour"), F.max("hour_ts").alias("last_hour"),
    )


def latest_kpis(kpis: DataFrame, n: int = 10) -> DataFrame:
    """Newest hours first, busiest zones first within an hour."""
    return kpis.orderBy(F.desc("hour_ts"), F.desc("trips"), "zone_id").limit(n)


def latest_kpi_rows(kpis: DataFrame, n: int = 20) -> DataFrame:
    return kpis.orderBy(F.desc("hour_ts"), "zone_id").limit(n)

"""Reports over staged trips, the KPI mart and the zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterline.functions.numeric import count_if, fixed_avg, fixed_sum, percent
from meterline.functions.trips import hour_start
from meterline.operators.kpis import CARD


def trip_report(trips: DataFrame) -> DataFrame:
    """Totals; distinct zones are counted on one row per pair of zones, not on copies of the trips."""
    amounts = {"fare_amount": "avg_fare", "tip_amount": "avg_tip", "total_amount": "avg_total"}
    pairs = trips.groupBy("pu_zone_id", "do_zone_id").agg(
        F.count("*").alias("_n"), *[fixed_sum(F.col(c)).alias(f"_{c}") for c in amounts], *[F.count(c).alias(f"_n_{c}") for c in amounts],
        F.min("pickup_ts").alias("_first"), F.max("pickup_ts").alias("_last"))
    return pairs.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_trips"),
        F.count_distinct("pu_zone_id").alias("pickup_zones"),
        F.count_distinct("do_zone_id").alias("dropoff_zones"),
        *[(fixed_sum(F.col(f"_{c}")) / F.nullif(F.sum(f"_n_{c}"), F.lit(0))).alias(name) for c, name in amounts.items()],
        F.min("_first").alias("earliest_trip"),
        F.max("_last").alias("latest_trip"),
    )


def kpi_report(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.count("*").alias("total_kpis"),
        F.count_distinct("zone_id").alias("zones_with_kpis"),
        fixed_avg(F.col("trips")).alias("avg_trips_per_hour"),
        fixed_avg(F.col("avg_fare")).alias("avg_fare_per_hour"),
        fixed_avg(F.col("avg_tip")).alias("avg_tip_per_hour"),
    )


def zone_report(zones: DataFrame) -> DataFrame:
    return zones.agg(
        F.count("*").alias("total_zones"),
        F.count_distinct("borough").alias("boroughs"),
        F.count_distinct("service_zone").alias("service_zones"),
    )


def top_zones(trips: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    """Busiest pickup zones. Trips shrink to one row per zone before they meet the dimension."""
    per_zone = trips.groupBy("pu_zone_id").agg(
        F.count("*").alias("trip_count"), fixed_avg(F.col("fare_amount")).alias("avg_fare"),
    )
    named = per_zone.join(zones, per_zone.pu_zone_id == zones.zone_id)
    return named.select("zone_id", "zone_name", "borough", "trip_count", "avg_fare") \
        .orderBy(F.desc("trip_count"), "zone_id").limit(n)


def top_zones_mart(kpis: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    """Busiest zone names of the mart, which shrinks to one row per zone before it meets the dimension."""
    sums = {c: fixed_sum(F.col(c)).alias(f"_{c}") for c in ("avg_fare", "avg_tip")}
    counts = [F.count(c).alias(f"_n_{c}") for c in sums]
    per_zone = kpis.groupBy("zone_id").agg(F.sum("trips").alias("_trips"), *sums.values(), *counts)
    averages = [(fixed_sum(F.col(f"_{c}")) / F.nullif(F.sum(f"_n_{c}"), F.lit(0))).alias(c) for c in sums]
    return per_zone.join(zones, "zone_id").groupBy("zone_name", "borough").agg(F.sum("_trips").alias("total_trips"), *averages).orderBy(F.desc("total_trips"), "zone_name", "borough").limit(n)


def revenue_stats(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("total_amount").isNotNull()).agg(
        F.count("*").alias("trips"),
        fixed_sum(F.col("total_amount")).alias("total_revenue"),
        fixed_avg(F.col("total_amount")).alias("avg_total"),
    )


def reconcile_source(trips: DataFrame) -> DataFrame:
    return trips.groupBy("source").agg(
        F.count("*").alias("trips"),
        F.min("pickup_ts").alias("first_trip"),
        F.max("pickup_ts").alias("last_trip"),
        fixed_sum(F.col("total_amount")).alias("total_revenue"),
    )


def reconcile_mart(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.count("*").alias("kpi_records"),
        F.count_distinct("zone_id").alias("zones_covered"),
        F.min("hour_ts").alias("first_hour"),
        F.max("hour_ts").alias("last_hour"),
        F.sum("trips").alias("total_trips_aggregated"),
    )


def peak_hours_mart(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy(F.hour("hour_ts").alias("hour_of_day")).agg(
        F.sum("trips").alias("total_trips"),
        fixed_avg(F.col("avg_fare")).alias("avg_fare"),
        fixed_avg(F.col("pct_card")).alias("pct_card"),
    )


def throughput_by_hour(trips: DataFrame, n: int = 48) -> DataFrame:
    """Trips per hour, newest hours only."""
    hours = trips.groupBy(hour_start(F.col("pickup_ts")).alias("hour_bucket")).agg(F.count("*").alias("trips"))
    return hours.orderBy(F.desc("hour_bucket")).limit(n)


def payment_mix(trips: DataFrame) -> DataFrame:
    """Trips and share per payment type, and whether it is the card type.

    The total is a one-row subquery over the same counts, so the trips are aggregated once.
    """
    counts = trips.groupBy("payment_type").agg(F.count("*").alias("trips"))
    total = counts.agg(F.sum("trips")).scalar()
    return counts.select(
        "payment_type", "trips", percent(F.col("trips"), total).alias("pct"),
        F.coalesce(F.col("payment_type") == CARD, F.lit(False)).alias("is_card"),
    )


def card_share(trips: DataFrame) -> DataFrame:
    return trips.agg(percent(count_if(F.col("payment_type") == CARD), F.count("*")).alias("pct_card"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def key_collisions(trips: DataFrame, key: str = "trip_key") -> DataFrame:
    one = trips.agg(F.count("*").alias("total"), F.count_distinct(key).alias("distinct_keys"))
    repeated = F.col("total") - F.col("distinct_keys")
    return one.select("total", "distinct_keys", repeated.alias("collisions"),
                      percent(repeated, F.col("total")).alias("collision_pct"))

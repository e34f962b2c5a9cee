"""Exploration profiles: distributions, statistics, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterline.functions.numeric import count_if, fixed_avg, percent
from meterline.functions.trips import duration_min, payment_label, speed, weekday_name
from meterline.operators.quantiles import exact_quantiles, per_metric, quantile_columns, quantiles_of_stored
from meterline.operators.quality import DROPOFF, PICKUP
from meterline.sources.store import saved

# Probabilities, histogram caps and bounds of a plausible trip.
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
HISTOGRAM_CAPS = {"distance_km": 50.0, "duration_min": 60.0, "avg_speed_kmh": 100.0, "fare_amount": 100.0}
HISTOGRAM_BINS = 50
MAX_MILES, MAX_MINUTES, MAX_MPH = 100, 180, 60
KEY_METRICS = ("distance_km", "duration_min", "avg_speed_kmh", "fare_amount")


def trips_by_hour(trips: DataFrame, ts: str) -> DataFrame:
    """Trips per hour of day, with the busiest and the slowest hour marked (the earlier one on a tie)."""
    hours = trips.groupBy(F.hour(ts).alias("hour")).agg(F.count("*").alias("trips"))
    extremes = hours.agg(
        F.max_by("hour", F.struct("trips", -F.col("hour"))).alias("peak"),
        F.min_by("hour", F.struct("trips", "hour")).alias("slowest"),
    )
    return hours.select(
        "hour", "trips",
        (F.col("hour") == extremes.select("peak").scalar()).alias("is_peak"),
        (F.col("hour") == extremes.select("slowest").scalar()).alias("is_slowest"),
    )


def trips_by_weekday(trips: DataFrame, ts: str) -> DataFrame:
    """Trips per weekday; ``day_number`` 0 is Monday."""
    return trips.groupBy(F.weekday(ts).alias("day_number"), weekday_name(F.col(ts)).alias("day_name")).agg(
        F.count("*").alias("trips")
    )


def dow_hour_matrix(trips: DataFrame, ts: str) -> DataFrame:
    """Weekday by hour counts, ``h00`` to ``h23``; missing cells are 0."""
    hours = [F.hour(ts).alias("hour"), F.weekday(ts).alias("day_number"), weekday_name(F.col(ts)).alias("day_name")]
    cells = trips.select(*hours).groupBy("day_number", "day_name").pivot("hour", list(range(24))).count()
    return cells.select(
        "day_number", "day_name", *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h:02d}") for h in range(24)]
    )


def daily_volume(trips: DataFrame, ts: str) -> DataFrame:
    return trips.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("trips"))


def fare_speed_by_hour(trips: DataFrame, ts: str = "pickup_ts") -> DataFrame:
    return trips.groupBy(F.hour(ts).alias("hour")).agg(
        fixed_avg(F.col("fare_amount")).alias("avg_fare"), fixed_avg(F.col("avg_speed_kmh")).alias("avg_speed_kmh"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and percent of all rows per value of each column; missing values are left out."""
    values = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns])
    counts = values.unpivot([], list(columns), "column_name", "value") \
        .groupBy("column_name", "value").agg(F.count("*").alias("row_count"))
    # the counts of one column, missing values included, add up to all rows: no second pass
    total = counts.agg(F.sum(F.when(F.col("column_name") == columns[0], F.col("row_count")))).scalar()
    return counts.where("value is not null").withColumn("pct", percent(F.col("row_count"), total))


def top_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of each column, one sorted limit per column."""
    counts = value_counts(df, columns)
    tops = [
        counts.where(F.col("column_name") == c).orderBy(F.desc("row_count"), "value").limit(n) for c in columns
    ]
    result = tops[0]
    for top in tops[1:]:
        result = result.unionByName(top)
    return result


def payment_labels(trips: DataFrame) -> DataFrame:
    """Trips and percent per payment label; a missing code has no label but counts in the total."""
    counts = trips.groupBy("payment_type").agg(F.count("*").alias("trips"))
    total = counts.agg(F.sum("trips")).scalar()
    return counts.where("payment_type is not null").select(
        "payment_type", payment_label(F.col("payment_type")).alias("label"), "trips",
        percent(F.col("trips"), total).alias("pct"),
    )


STATISTICS = {"row_count": F.count, "mean": fixed_avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def statistics(df: DataFrame, columns: Sequence[str], quantiles: Mapping[float, str]) -> DataFrame:
    """Count, mean, sample deviation, range and exact quantiles, one row per column."""
    stored = saved(df.select(*columns), "statistics")
    rows = per_metric(stored, columns, STATISTICS)
    # both sides have one row per column
    return rows.join(quantile_columns(quantiles_of_stored(stored, columns, list(quantiles)), dict(quantiles)), "metric", "left")


def plausible_trips(raw: DataFrame) -> DataFrame:
    """Trips with a plausible distance and duration, with the duration, computed if not there, and the speed, NULL if not plausible."""
    rows = raw if "trip_duration_min" in raw.columns else raw.withColumn("trip_duration_min", duration_min(F.col(PICKUP), F.col(DROPOFF)))
    miles, minutes = F.col("trip_distance"), F.col("trip_duration_min")
    mph = speed(miles, minutes)
    valid = rows.where((miles > 0) & (miles < MAX_MILES) & (minutes > 0) & (minutes < MAX_MINUTES))
    return valid.withColumn("avg_speed_mph", F.when((mph > 0) & (mph < MAX_MPH), mph))


def trip_distance_stats(raw: DataFrame) -> DataFrame:
    """Statistics of distance and duration of all plausible trips, and of their plausible speeds."""
    return statistics(plausible_trips(raw), ["trip_distance", "trip_duration_min", "avg_speed_mph"], {0.5: "median"})


def speed_mph_stats(raw: DataFrame) -> DataFrame:
    return statistics(plausible_trips(raw).where("avg_speed_mph is not null"), ["avg_speed_mph"], {0.5: "median"})


def fare_stats(raw: DataFrame) -> DataFrame:
    """Statistics of positive fares and of all totals."""
    fares = raw.select(F.when(F.col("fare_amount") > 0, F.col("fare_amount")).alias("fare_amount"), "total_amount")
    return statistics(fares, ["fare_amount", "total_amount"], {0.5: "median"})


def tip_analysis(raw: DataFrame) -> DataFrame:
    tip, fare = F.col("tip_amount"), F.col("fare_amount")
    tipped = tip > 0
    return raw.agg(
        count_if(tipped).alias("tipped_trips"),
        percent(count_if(tipped), F.count("*")).alias("tipped_pct"),
        fixed_avg(F.when(tipped, tip)).alias("avg_tip"),
        fixed_avg(F.when(tipped, tip / F.nullif(fare, F.lit(0.0)) * 100)).alias("avg_tip_pct"),
    )


def passenger_stats(raw: DataFrame) -> DataFrame:
    """Trips per positive passenger count, percent of all trips, and the average over them."""
    counts = raw.groupBy("passenger_count").agg(F.count("*").alias("trips"))
    some = F.col("passenger_count") > 0
    totals = counts.agg(
        F.sum("trips").alias("total"),
        (F.sum(F.when(some, F.col("passenger_count") * F.col("trips")))
         / F.nullif(F.sum(F.when(some, F.col("trips"))), F.lit(0))).alias("average"),
    )
    return counts.where(some).select(
        "passenger_count", "trips", percent(F.col("trips"), totals.select("total").scalar()).alias("pct"),
        totals.select("average").scalar().alias("avg_passengers"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, range and quartiles of every numeric column."""
    return statistics(df, columns or numeric_columns(df), {0.25: "p25", 0.5: "p50", 0.75: "p75"})


def null_profile(df: DataFrame) -> DataFrame:
    """Type, null count and null percent per column."""
    one = df.agg(F.count("*").alias("_total"), *[count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"`{f.name}`").alias("null_count"),
                 percent(F.col(f"`{f.name}`"), F.col("_total")).alias("null_pct"))
        for f in df.schema.fields
    ])
    return one.select(F.inline(rows))


def overview(trips: DataFrame, ts: str = "pickup_ts") -> DataFrame:
    first, last = F.min(ts), F.max(ts)
    return trips.agg(
        F.count("*").alias("row_count"),
        F.lit(len(trips.columns)).alias("column_count"),
        first.alias("first_pickup"), last.alias("last_pickup"),
        F.floor(F.timestamp_diff("SECOND", first, last) / 86_400).alias("span_days"),
        *[fixed_avg(F.col(c)).alias(f"avg_{c}") for c in (*KEY_METRICS, "tip_amount")],
    )


def month_summary(trips: DataFrame, month: Column) -> DataFrame:
    """Rows and averages per month, and over all months (``TOTAL``)."""
    rows = trips.withColumn("month", month).rollup("month").agg(
        F.count("*").alias("row_count"),
        *[fixed_avg(F.col(c)).alias(f"avg_{c}") for c in ("distance_km", "duration_min", "fare_amount")],
        F.grouping("month").alias("_total"),
    )
    return rows.withColumn("month", F.when(F.col("_total") == 1, F.lit("TOTAL")).otherwise(F.col("month"))).drop("_total")


def histograms(trips: DataFrame, caps: Mapping[str, float] = HISTOGRAM_CAPS, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins of the values up to a cap, empty bins included, with the uncapped median.

    Values are counted per bin where they are read; only bin counts are shuffled.
    """
    columns = list(caps)
    trips = saved(trips.select(*columns), "histograms")
    capped = trips.select(*[F.when(F.col(c) <= cap, F.col(c)).alias(c) for c, cap in caps.items()])
    ranges = per_metric(capped, columns, {"lo": F.min, "hi": F.max}).where("lo is not null")
    same = F.col("lo") == F.col("hi")
    ranges = ranges.select("metric", F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                           F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    medians = quantile_columns(quantiles_of_stored(trips, columns, [0.5]), {0.5: "median"})
    # one row per metric
    frame = ranges.join(medians, "metric")
    values = capped.unpivot([], columns, "metric", "value").where("value is not null").join(F.broadcast(ranges), "metric")
    position = F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    counts = values.groupBy("metric", F.least(position, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("row_count")
    )
    grid = frame.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, ["metric", "bin"], "left").select(
        "metric", "bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"), "median",
    )


def sample_rows(trips: DataFrame, n: int, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return trips.orderBy(*order).limit(n).select(*columns)

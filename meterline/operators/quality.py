"""Curation rules, reject accounting and data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.numeric import count_if, fixed_avg, percent
from meterline.functions.trips import distance_km, duration_min, seconds_between, speed
from meterline.schemas import MAX_SPEED_KMH, RAW_TO_CURATED

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
REJECT_REASONS = ("temporal_invalid", "speed_invalid", "negative_amount")
DERIVED = ("distance_km", "duration_min", "avg_speed_kmh")


def holds(condition: Column) -> Column:
    """A rule on missing values does not hold."""
    return F.coalesce(condition, F.lit(False))


def derived_fields(df: DataFrame) -> DataFrame:
    km = distance_km(F.col("trip_distance"))
    minutes = duration_min(F.col(PICKUP), F.col(DROPOFF))
    return df.withColumns({"distance_km": km, "duration_min": minutes, "avg_speed_kmh": speed(km, minutes)})


def derived_ranges(df: DataFrame) -> DataFrame:
    return df.agg(*[f(c).alias(f"{c}_{n}") for c in DERIVED for n, f in (("min", F.min), ("max", F.max))])


def curation_rules(pickup: str = PICKUP, dropoff: str = DROPOFF) -> dict[str, Column]:
    """Reject reason to the condition of a good row, in the order in which they are charged.

    Conditions are plain comparisons, so a filter made of them reaches the parquet scan.
    """
    conditions = (
        F.col(pickup) < F.col(dropoff),
        F.coalesce(F.col("avg_speed_kmh") <= MAX_SPEED_KMH, F.lit(True)),
        F.col("total_amount") >= 0,
    )
    return dict(zip(REJECT_REASONS, conditions))


def reject_reason() -> Column:
    """Name of the first failed curation rule, NULL for a good row: all rules in one pass."""
    return F.coalesce(*[F.when(~holds(ok), F.lit(reason)) for reason, ok in curation_rules().items()])


def with_reject_reason(df: DataFrame) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason())


def dq_filter(df: DataFrame) -> DataFrame:
    """Rows that pass every curation rule."""
    return df.where(reduce(and_, curation_rules().values()))


def dq_rejections(df: DataFrame) -> DataFrame:
    """Rejected rows per rule; every rule has a row, also with count 0."""
    counts = with_reject_reason(df).agg(
        *[count_if(F.col("reject_reason") == r).alias(r) for r in REJECT_REASONS]
    )
    return counts.unpivot([], list(REJECT_REASONS), "rule", "rejected")


def curation_measures() -> list[Column]:
    reason = F.col("reject_reason")
    kept = count_if(reason.isNull())
    return [
        F.count("*").alias("input_rows"),
        kept.alias("output_rows"),
        percent(kept, F.count("*")).alias("retention_rate"),
        *[count_if(reason == r).alias(r) for r in REJECT_REASONS],
    ]


def curation_stats(df: DataFrame) -> DataFrame:
    return with_reject_reason(df).agg(*curation_measures())


def curation_summary(df: DataFrame, month: Column) -> DataFrame:
    """Curation statistics per month and a total row (month ``TOTAL``) from one pass."""
    rows = with_reject_reason(df).withColumn("month", month)
    return rows.rollup("month").agg(*curation_measures(), F.grouping("month").alias("_total")).withColumn(
        "month", F.when(F.col("_total") == 1, F.lit("TOTAL")).otherwise(F.col("month"))
    ).drop("_total")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Raw to curated names. Names match exactly, so ``airport_fee`` beside ``Airport_fee`` is not lost."""
    exact = [c for c in df.columns if c in RAW_TO_CURATED and RAW_TO_CURATED[c] != c]
    taken = {c for c in df.columns if c not in exact}
    return df.select([
        F.col(f"`{c}`").alias(RAW_TO_CURATED[c] if c in exact and RAW_TO_CURATED[c] not in taken else c)
        for c in df.columns
    ])


def curate(raw: DataFrame) -> DataFrame:
    """Raw month to curated month: derive, filter, rename. One projection over one scan."""
    return standardize_columns(dq_filter(derived_fields(raw)))


def verify_curated(df: DataFrame, month: Column) -> DataFrame:
    """Per month: row count and whether each curation rule holds for all rows."""
    missing = [c for c in DERIVED if c not in df.columns]
    if missing:
        raise ValueError(f"curated table lacks derived columns: {missing}")
    return df.withColumn("month", month).groupBy("month").agg(
        F.count("*").alias("row_count"),
        *[F.every(holds(ok)).alias(name) for name, ok in zip(
            ("temporal_ok", "speed_ok", "amount_ok"), curation_rules("pickup_ts", "dropoff_ts").values())],
    )


KEY_COLUMNS = (PICKUP, "PULocationID", "DOLocationID", "fare_amount", "tip_amount")


def sanity_check(df: DataFrame) -> DataFrame:
    """One row per required raw column: present, null count and percent; fare and distance ranges."""
    present = [c for c in KEY_COLUMNS if c in df.columns]
    ranged = [c for c in ("fare_amount", "trip_distance") if c in df.columns]
    total = F.count("*")
    one = df.agg(
        total.alias("total"),
        *[count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in present],
        *[agg(F.col(c)).alias(f"{n}_{c}") for c in ranged
          for n, agg in (("min", F.min), ("max", F.max), ("avg", fixed_avg))],
    )
    none_d, none_l = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in df.columns).alias("present"),
            (F.col(f"nulls_{c}") if c in present else none_l).alias("null_count"),
            (percent(F.col(f"nulls_{c}"), F.col("total")) if c in present else none_d).alias("null_pct"),
            *[(F.col(f"{n}_{c}") if c in ranged else none_d).alias(f"{n}_value") for n in ("min", "max", "avg")],
        )
        for c in (*KEY_COLUMNS, "trip_distance")
    ]
    return one.select(F.inline(F.array(*rows)))


def dq_issue_counts(df: DataFrame) -> DataFrame:
    seconds = seconds_between(F.col(PICKUP), F.col(DROPOFF))
    issues: Mapping[str, Column] = {
        "negative_fare": F.col("fare_amount") < 0,
        "zero_distance": F.col("trip_distance") == 0,
        "negative_duration": seconds < 0,
        "zero_duration": seconds == 0,
        "null_pickup_zone": F.col("PULocationID").isNull(),
        "null_dropoff_zone": F.col("DOLocationID").isNull(),
    }
    one = df.agg(F.count("*").alias("total"), *[count_if(c).alias(n) for n, c in issues.items()])
    rows = one.unpivot(["total"], list(issues), "issue", "row_count")
    return rows.select("issue", "row_count", percent(F.col("row_count"), F.col("total")).alias("row_pct"))


def documented_rules(zones: DataFrame, df: DataFrame) -> DataFrame:
    """Failure counts of the optional, only documented rules: duration, fare, zones, time order."""
    pu = zones.select(F.col("zone_id").alias("pu_zone_id"), F.lit(True).alias("pu_known"))
    do = zones.select(F.col("zone_id").alias("do_zone_id"), F.lit(True).alias("do_known"))
    rows = df.join(pu, "pu_zone_id", "left").join(do, "do_zone_id", "left")
    seconds = seconds_between(F.col("pickup_ts"), F.col("dropoff_ts"))
    # Documented bounds.
    rules: Mapping[str, Column] = {
        "duration": (seconds >= 1) & (seconds <= 86_400),
        "fare": (F.col("fare_amount") >= 0.01) & (F.col("fare_amount") <= 500.0),
        "zones": F.col("pu_known") & F.col("do_known"),
        "chronological": F.col("pickup_ts") < F.col("dropoff_ts"),
    }
    one = rows.agg(*[count_if(~holds(c)).alias(n) for n, c in rules.items()])
    return one.unpivot([], list(rules), "rule", "failed")


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])

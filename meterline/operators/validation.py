"""Field rules of trips, zones and contract events.

A rule is a plain condition of a valid row; a missing value does not satisfy it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from meterline.schemas import CONTRACT_EVENT_TYPES

# Allowed ranges.
VENDORS = (1, 6)
ZONES = (1, 265)
PASSENGERS = (0, 9)
PAYMENT_TYPES = (1, 6)
MAX_TOTAL = 1000.0
KEY_LENGTH, VEHICLE_LENGTH = 64, 16
ZONE_TEXT_LENGTHS = {"borough": 50, "zone_name": 100, "service_zone": 50}


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def required_between(column: str, bounds: tuple[int, int]) -> Column:
    return F.col(column).between(*bounds)


def optional_between(column: str, bounds: tuple[int, int]) -> Column:
    return F.col(column).isNull() | F.col(column).between(*bounds)


def optional_not_negative(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) >= 0)


def required_text(column: str, length: int) -> Column:
    return F.length(column) <= length


def update_rules() -> dict[str, Column]:
    """Rules of a partial update: all values optional."""
    return {
        "passenger_count": optional_between("passenger_count", PASSENGERS),
        "trip_distance": optional_not_negative("trip_distance"),
        "fare_amount": optional_not_negative("fare_amount"),
        "tip_amount": optional_not_negative("tip_amount"),
        "total_amount": optional_not_negative("total_amount"),
        "payment_type": optional_between("payment_type", PAYMENT_TYPES),
    }


def create_rules() -> dict[str, Column]:
    """Rules of a new trip: identity, zones and times required."""
    return {
        "vendor_id": required_between("vendor_id", VENDORS),
        "pickup_ts": F.col("pickup_ts").isNotNull(),
        "dropoff_ts": F.col("dropoff_ts") > F.col("pickup_ts"),
        "pu_zone_id": required_between("pu_zone_id", ZONES),
        "do_zone_id": required_between("do_zone_id", ZONES),
        **update_rules(),
        "vehicle_id_h": required_text("vehicle_id_h", VEHICLE_LENGTH),
    }


def complete_rules() -> dict[str, Column]:
    """Rules of a staged trip: those of a new one, a key and an upper bound on the total."""
    total = F.col("total_amount")
    return {
        "trip_key": required_text("trip_key", KEY_LENGTH),
        **create_rules(),
        "total_amount": total.isNull() | total.between(0, MAX_TOTAL),
    }


def zone_rules() -> dict[str, Column]:
    texts = {c: required_text(c, n) for c, n in ZONE_TEXT_LENGTHS.items()}
    return {"zone_id": F.col("zone_id").isNotNull(), **texts}


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that do not hold, in rule order; empty for a valid row."""
    return F.array_compact(F.array(*[F.when(~_holds(ok), F.lit(name)) for name, ok in rules.items()]))


def only_valid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break no rule, as plain filters that can reach the scan."""
    return df.where(reduce(and_, rules.values()))


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.withColumn("failed_rules", failed_rules(rules))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the rule column, and rejected rows with it."""
    ok = F.size("failed_rules") == 0
    return validated.where(ok).drop("failed_rules"), validated.where(~ok)


def failures_by_rule(validated: DataFrame) -> DataFrame:
    """Rejected rows per broken rule; a row that breaks two counts in both."""
    return (
        validated.select(F.explode("failed_rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("failures"))
    )


def contract_failed_rules(strict: bool = False) -> Column:
    """Rules of a flat contract event, chosen by its type.

    ``strict`` also demands that the event time equals the pickup or dropoff time; that check is
    off by default because the published one never fires.
    """
    def not_negative(column: str) -> Column:
        return F.col(column) >= 0

    identity = {
        "vendor_id": required_between("vendor_id", VENDORS),
        "pickup_ts": F.col("pickup_ts").isNotNull(),
        "pu_zone_id": required_between("pu_zone_id", ZONES),
        "do_zone_id": required_between("do_zone_id", ZONES),
    }
    drop = {
        "dropoff_ts": F.col("dropoff_ts").isNotNull(),
        "do_zone_id": required_between("do_zone_id", ZONES),
        "total_amount": not_negative("total_amount"),
    }
    if strict:
        identity["event_ts"] = F.col("event_ts") == F.col("pickup_ts")
        drop["event_ts"] = F.col("event_ts") == F.col("dropoff_ts")
    by_type = {
        "IDENTITY": identity,
        "PASSENGERS": {"passenger_count": required_between("passenger_count", PASSENGERS)},
        "FARE": {
            "fare_amount": not_negative("fare_amount"),
            "trip_distance": not_negative("trip_distance"),
            "payment_type": required_between("payment_type", PAYMENT_TYPES),
        },
        "DROP": drop,
        "TIP": {"tip_amount": not_negative("tip_amount")},
    }
    base = failed_rules({
        "event_ts": F.col("event_ts").isNotNull(),
        "trip_key": required_text("trip_key", KEY_LENGTH),
        "vehicle_id_h": required_text("vehicle_id_h", VEHICLE_LENGTH),
    })
    own = F.array(F.lit("event_type"))
    for event_type in reversed(CONTRACT_EVENT_TYPES):
        own = F.when(F.col("event_type") == event_type, failed_rules(by_type[event_type])).otherwise(own)
    return F.array_distinct(F.concat(base, own))


def validate_contract_events(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumn("failed_rules", contract_failed_rules(strict))

"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from meterline.schemas import KM_PER_MILE, PAYMENT_LABELS

SECONDS_PER_MINUTE = 60.0


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as double; works on timestamps without zone, which cannot be cast."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def distance_km(miles: Column) -> Column:
    return miles * F.lit(KM_PER_MILE)


def duration_min(pickup: Column, dropoff: Column) -> Column:
    return seconds_between(pickup, dropoff) / F.lit(SECONDS_PER_MINUTE)


def speed(distance: Column, minutes: Column) -> Column:
    """Distance per hour; NULL when the trip took no time."""
    return F.try_divide(distance, minutes / F.lit(SECONDS_PER_MINUTE))


def has_tip(tip: Column) -> Column:
    return F.coalesce(tip > 0, F.lit(False))


def is_complete(vendor: Column, pickup: Column, dropoff: Column, pu_zone: Column, do_zone: Column,
                key: Column, vehicle: Column) -> Column:
    """All seven required values present; 0 and empty text count as missing."""
    numbers = [F.coalesce(c != 0, F.lit(False)) for c in (vendor, pu_zone, do_zone)]
    texts = [F.coalesce(c != "", F.lit(False)) for c in (key, vehicle)]
    done = pickup.isNotNull() & dropoff.isNotNull()
    for condition in numbers + texts:
        done = done & condition
    return done


def payment_label(code: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in PAYMENT_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, code), F.concat(F.lit("Type "), code.cast("string")))


def hour_start(ts: Column) -> Column:
    """Start of the hour, still without time zone (``date_trunc`` alone would add one)."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")

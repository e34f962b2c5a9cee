"""Deterministic hashed identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from meterline.schemas import DEFAULT_FLEET_SIZE

# Fixed format: ISO 8601 without a fraction when there is none, with six digits otherwise.
ISO_SECONDS_LENGTH = len("2025-01-01T00:00:00")
ISO_MICROS_LENGTH = len("2025-01-01T00:00:00.000000")
SEPARATOR = "|"
VEHICLE_PREFIX = "veh_"
VEHICLE_DIGITS = 12


def iso_text(ts: Column) -> Column:
    """The text cast drops trailing zeros of a fraction; they are put back. One formatting per value."""
    text = F.translate(ts.cast("string"), " ", "T")
    width = F.when(F.length(text) == ISO_SECONDS_LENGTH, ISO_SECONDS_LENGTH).otherwise(ISO_MICROS_LENGTH)
    return F.rpad(text, width, F.lit("0"))


def _joined_hash(*parts: Column) -> Column:
    """SHA-256 of the parts; ``concat`` keeps the result NULL when a part is, unlike ``concat_ws``."""
    texts = [p.cast("string") for p in parts]
    pieces = [texts[0]]
    for text in texts[1:]:
        pieces += [F.lit(SEPARATOR), text]
    return F.sha2(F.concat(*pieces), 256)


def trip_key(salt: str, vendor: Column, pickup: Column, pu_zone: Column, row_offset: Column) -> Column:
    return _joined_hash(F.lit(salt), vendor.cast("bigint"), iso_text(pickup), pu_zone.cast("bigint"), row_offset)


def vehicle_id(salt: str, vendor: Column, row_offset: Column, fleet_size: int = DEFAULT_FLEET_SIZE) -> Column:
    """One of ``fleet_size`` vehicles per vendor, the same one for the same row position."""
    slot = F.pmod(row_offset, F.lit(fleet_size))
    digest = _joined_hash(F.lit(salt), F.lit("vehicle"), vendor.cast("bigint"), slot)
    return F.concat(F.lit(VEHICLE_PREFIX), F.substring(digest, 1, VEHICLE_DIGITS))


def event_id(key: Column, event_type: Column) -> Column:
    """Stable event id: a replay or a retried task gives the same one."""
    return _joined_hash(key, event_type)


def hash_percent(key: Column) -> Column:
    """A number 0..99 that depends only on the key."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint"), F.lit(100))

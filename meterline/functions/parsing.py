"""Parsing of untrusted text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_int(text: Column, default: int = 0) -> Column:
    """Whole number or the default; decimal text such as ``15.5`` is not a whole number."""
    return F.coalesce(text.try_cast("int"), F.lit(default))


# Fixed format: what counts as a number in text.
FLOAT_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)\s*$"


def float_or_null(text: Column) -> Column:
    """Number or NULL. Text of another form is not handed to the cast, which would raise and
    catch an error per row, and would take suffixes such as ``1.5f``."""
    return F.when(text.rlike(FLOAT_PATTERN), text.try_cast("double"))


def safe_float(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(float_or_null(text), F.lit(default))


# Fixed format: a whole date, and a time after it if any.
DATE_PATTERN = r"^\s*\d{4}-\d{2}-\d{2}([T ].+)?\s*$"


def iso_timestamp(text: Column) -> Column:
    """Timestamp without zone from ISO text (``Z`` and offsets are taken to UTC); NULL when malformed.

    Text without a whole date is malformed: the cast would take a time alone for today.
    """
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("timestamp")).cast("timestamp_ntz")

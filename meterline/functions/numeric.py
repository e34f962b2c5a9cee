"""Sums and averages that do not depend on task order, and NULL-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MICROS = 1_000_000.0
_SUMMABLE = T.DecimalType(28, 0)
#: Below this every double in millionths is a long; above it doubles are whole numbers anyway.
_LONG_MICROS = 9.0e15


def fixed_sum(value: Column) -> Column:
    """Sum in whole millionths, returned as double.

    Floating sums change in the last digits with the order in which partial results arrive, so a
    retried task would rewrite a KPI with another value. Integers add up the same in any order.
    Values up to 1e21 are taken, at any row count; a NaN or an infinite value makes the sum NULL.
    """
    value = value.cast("double")
    total = F.sum(whole_micros(value)).cast("double") / F.lit(MICROS)
    return F.when(F.coalesce(F.bool_and(is_finite(value)), F.lit(True)), total)


def whole_micros(value: Column) -> Column:
    """A double in whole millionths; NULL for NULL, NaN and infinite values."""
    micros = value * F.lit(MICROS) + F.lit(0.5)
    return F.when(F.abs(micros) < _LONG_MICROS, F.floor(micros).cast(_SUMMABLE)).when(is_finite(value), micros.cast(_SUMMABLE))


def is_finite(value: Column) -> Column:
    """NULL for NULL; comparisons take NaN for the greatest value."""
    return F.abs(value) < F.lit(float("inf"))


def fixed_avg(value: Column) -> Column:
    """Average of the non-NULL values, from ``fixed_sum``; NULL when there is none."""
    return fixed_sum(value) / F.nullif(F.count(value), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; NULL when the whole is 0."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def max_text(value: Column) -> Column:
    """Greatest text per group, for few groups of very many rows.

    Aggregates of text alone make Spark order all rows by group first. The set beside it, always empty, lets the whole
    aggregate hash instead; beyond some hundred groups in a task Spark goes back to ordering.
    """
    return F.when(F.size(F.collect_set(F.lit(None).cast("int"))) == 0, F.max(value))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers written as NaN become NULL, so that comparisons and averages skip them."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast("double")) for c in floats}) if floats else df

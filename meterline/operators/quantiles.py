"""Exact quantiles of whole columns; no task orders more than a fixed number of values."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.sources.store import saved

SLOTS = 256
POINTS = 500
SKETCH_ACCURACY = 5_000
#: Parts into which a sketch cuts an interval that is too wide.
PARTS = 64
MARGIN = 0.25 / PARTS
#: Values of an interval that one task may order.
MOST_ORDERED = 1 << 20


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(metric, value)`` rows of the non-NULL values of the columns."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot([], list(columns), "metric", "value").where(F.col("value").isNotNull())


def per_metric(df: DataFrame, columns: Sequence[str], measures: dict[str, object], *by: str) -> DataFrame:
    """One row per column (and group) with the given aggregates, from one pass over ``df``.

    ``measures`` maps a name to a function from Column to aggregate Column.
    """
    structs = [
        F.struct(F.lit(c).alias("metric"), *[make(F.col(c)).alias(n) for n, make in measures.items()]) for c in columns
    ]
    return df.groupBy(*by).agg(F.array(*structs).alias("_rows")).select(*by, F.inline("_rows"))


def cut_values(df: DataFrame, columns: Sequence[str], edges: Sequence[float]) -> DataFrame:
    """``(metric, cuts)``: about the values at the ``edges``, from a sketch merged in two levels.

    The sketches of the reading tasks are first merged in up to ``SLOTS`` groups; only the points
    of those, a number that does not depend on the data, meet in one task.
    """
    grid = F.array(*[F.lit(i / POINTS) for i in range(POINTS + 1)])
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns],
                        (F.spark_partition_id() % SLOTS).alias("slot"))
    merged = per_metric(numbers, columns, {
        "points": lambda c: F.percentile_approx(c, grid, SKETCH_ACCURACY), "weight": F.count,
    }, "slot").where("weight > 0")
    points = merged.select("metric", "weight", F.explode("points").alias("point"))
    return points.groupBy("metric").agg(F.percentile("point", list(edges), F.col("weight")).alias("cuts"))


@dataclass(frozen=True)
class Interval:
    """Values of a column strictly between two bounds: ``n`` of them, after ``start`` smaller ones, with the ranks wanted among them."""

    metric: str
    low: float
    high: float
    start: int
    n: int
    ranks: tuple[int, ...]

    def values(self) -> Column:
        value = F.col(self.metric).cast("double")
        # NaN is the greatest value
        above = value > F.lit(self.low) if self.low != -math.inf else F.lit(True)
        return F.when(above & (value < F.lit(self.high)) if self.high is not None else above, value)


def _position(total: int, probability: float) -> float:
    return (total - 1) * probability


def _ranks(total: int, probabilities: Sequence[float]) -> tuple[int, ...]:
    places = [_position(total, p) for p in probabilities]
    return tuple(sorted({f(x) for x in places for f in (math.floor, math.ceil)}))


def narrow(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], most: int = MOST_ORDERED) -> tuple[dict[str, int], list[Interval], list[tuple[str, int, float]]]:
    """Number of values per column, the intervals of at most ``most`` values that hold the wanted ranks, and ranks found on the way.

    A sketch proposes cuts inside every wider interval; rows are then counted between and on the cuts, where they are read, and
    those counts are exact. A rank that falls on a cut is known; others go on in the interval between their cuts. Only cuts and
    counts come to the driver, a number that depends on the columns and probabilities and not on the rows.
    """
    n = df.agg(*[F.count(F.col(c).cast("double")).alias(c) for c in columns]).first()
    totals = {c: n[c] for c in columns if n[c]}
    todo = [Interval(c, -math.inf, None, 0, t, _ranks(t, probabilities)) for c, t in totals.items()]
    done, known = [], []
    while todo:
        done += [i for i in todo if i.n <= most]
        wide = {f"i{k}": i for k, i in enumerate(i for i in todo if i.n > most)}
        todo = []
        if not wide:
            break
        inside = df.select(*[i.values().alias(name) for name, i in wide.items()])
        grid = [k / PARTS for k in range(PARTS + 1)]
        cuts = {name: _near(wide[name], sorted(set(found))) for name, found in cut_values(inside, list(wide), grid).collect()}
        # even numbers lie between cuts, odd ones on a cut
        places = [F.struct(F.lit(name).alias("name"), F.when(F.col(name).isNotNull(), sum(
            ((F.col(name) > F.lit(c)).cast("int") + (F.col(name) >= F.lit(c)).cast("int") for c in cut), F.lit(0))).alias("place")) for name, cut in cuts.items()]
        counted = inside.select(F.inline(F.array(*places))).where("place is not null").groupBy("name", "place").agg(F.count("*").alias("n")).collect()
        for name, interval in wide.items():
            at, bounds = interval.start, [interval.low, *cuts[name], interval.high]
            for place, size in sorted((r.place, r.n) for r in counted if r.name == name):
                ranks = tuple(r for r in interval.ranks if at <= r < at + size)
                if place % 2:
                    known += [(interval.metric, r, bounds[(place + 1) // 2]) for r in ranks]
                elif ranks:
                    todo.append(Interval(interval.metric, bounds[place // 2], bounds[place // 2 + 1], at, size, ranks))
                at += size
    return totals, done, known


def _near(interval: Interval, cuts: list[float]) -> list[float]:
    """The cuts that lie about the wanted ranks; an interval's first and last value are always among them."""
    step = interval.n / max(len(cuts) - 1, 1)
    places = [(r - interval.start) / step for r in interval.ranks]
    return [c for k, c in enumerate(cuts) if k in (0, len(cuts) - 1) or any(abs(k - p) <= 2 for p in places)]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], most: int = MOST_ORDERED) -> DataFrame:
    """``(metric, probability, quantile)`` with linear interpolation between the closest ranks.

    The columns are written once, because they are read several times and may come out of joins.
    """
    if not probabilities:
        raise ValueError("no probabilities")
    return quantiles_of_stored(saved(df.select(*columns), "quantiles"), columns, probabilities, most)


def quantiles_of_stored(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], most: int = MOST_ORDERED) -> DataFrame:
    """:func:`exact_quantiles` of a table that is cheap to read again.

    :func:`narrow` finds small intervals around the wanted ranks. Only their values are shuffled, equal ones as one row with
    their count, and ordered, one interval to a task. The sketch decides how fast that goes, never what the answer is.
    """
    spark = df.sparkSession
    totals, intervals, known = narrow(df, columns, probabilities, most)
    # bounded by columns and probabilities
    wanted = F.broadcast(spark.createDataFrame(
        [(c, float(p), _position(t, p), f(_position(t, p))) for c, t in totals.items() for p in probabilities for f in (math.floor, math.ceil)],
        "metric string, probability double, position double, rank bigint").distinct())
    found = spark.createDataFrame(known, "metric string, rank bigint, value double")
    if intervals:
        rows = [F.struct(F.lit(i.metric).alias("metric"), F.lit(k).alias("segment"), F.lit(i.start).cast("bigint").alias("start"), i.values().alias("value")) for k, i in enumerate(intervals)]
        counted = (
            df.select(F.inline(F.array(*rows))).where("value is not null")
            .groupBy("metric", "segment", "start", "value").agg(F.count("*").alias("n"))
        )
        inside = Window.partitionBy("metric", "segment").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        ordered = counted.withColumn("upto", F.col("start") + F.sum("n").over(inside)).withColumn("from", F.col("upto") - F.col("n"))
        ranks = F.broadcast(spark.createDataFrame([(k, r) for k, i in enumerate(intervals) for r in i.ranks], "segment int, rank bigint"))
        hits = ordered.join(ranks, "segment").where((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("upto")))
        found = found.unionByName(hits.select("metric", "rank", "value"))
    low, high = F.min("value"), F.max("value")
    fraction = F.max("position") - F.floor(F.max("position"))
    return found.join(wanted, ["metric", "rank"]).groupBy("metric", "probability").agg((low * (1.0 - fraction) + high * fraction).alias("quantile"))


def approximate_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                          accuracy: int = 10_000) -> DataFrame:
    """One-pass sketch form for months too large for exact answers."""
    probs = [float(p) for p in probabilities]
    rows = per_metric(df, columns, {"q": lambda c: F.percentile_approx(c, probs, accuracy)})
    return rows.select("metric", F.inline(F.arrays_zip(
        F.array(*map(F.lit, probs)).alias("probability"), F.col("q").alias("quantile"))))


def quantile_columns(quantiles: DataFrame, names: dict[float, str]) -> DataFrame:
    """One row per metric with a column per named probability."""
    return quantiles.groupBy("metric").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(n) for p, n in names.items()
    ])

"""Pipeline metrics as data: counters, bucket histograms, rates, alerts, log and metric text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.numeric import count_if, fixed_sum
from meterline.functions.parsing import float_or_null
from meterline.schemas import LATENCY_BUCKETS

# Line formats, windows and alert rules.
LOG_PATTERN = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})?)\s+"
    r"(DEBUG|INFO|WARN|WARNING|ERROR|CRITICAL|FATAL)\s+(?:\[([^\]]+)\]\s+)?(.*)"
)
RATE_WINDOW, RATE_STEP, RATE_SECONDS = "5 minutes", "1 minute", 300.0


@dataclass(frozen=True)
class AlertLimits:
    """Thresholds, and the minutes for which each must hold."""

    lag_seconds: float = 30.0
    lag_minutes: int = 2
    failures_per_second: float = 0.1
    failure_minutes: int = 5
    error_share: float = 0.05
    error_minutes: int = 5


def bucket_histogram(df: DataFrame, value: Column, buckets: Sequence[float], *labels: str) -> DataFrame:
    """Cumulative counts per upper bound, plus ``+Inf``, the sum and the count, per label set.

    All bounds are counted in one aggregate; rows are not multiplied per bucket.
    """
    names = [f"_b{i}" for i in range(len(buckets))]
    one = df.groupBy(*labels).agg(
        *[count_if(value <= b).alias(n) for n, b in zip(names, buckets)],
        F.count(value).alias("total_count"), fixed_sum(value).alias("total_sum"),
    )
    rows = F.array(
        *[F.struct(F.lit(float(b)).alias("le"), F.col(n).alias("cumulative_count")) for n, b in zip(names, buckets)],
        F.struct(F.lit(float("inf")).alias("le"), F.col("total_count").alias("cumulative_count")),
    )
    return one.select(*labels, "total_count", "total_sum", F.inline(rows))


def bucket_quantiles(df: DataFrame, value: Column, probabilities: Sequence[float],
                     buckets: Sequence[float] = LATENCY_BUCKETS, *labels: str) -> DataFrame:
    """Quantiles interpolated inside the bucket that holds the rank.

    A rank beyond the last finite bound gives that bound.
    """
    names = [f"_b{i}" for i in range(len(buckets))]
    one = df.groupBy(*labels).agg(
        *[count_if(value <= b).cast("double").alias(n) for n, b in zip(names, buckets)],
        F.count(value).cast("double").alias("_n"),
    )
    rows = one.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    rank = F.col("probability") * F.col("_n")
    estimate = F.lit(float(buckets[-1]))
    for i in reversed(range(len(buckets))):
        lower, below = (F.lit(float(buckets[i - 1])), F.col(names[i - 1])) if i else (F.lit(0.0), F.lit(0.0))
        width = F.lit(float(buckets[i])) - lower
        inside = lower + width * (rank - below) / F.nullif(F.col(names[i]) - below, F.lit(0.0))
        estimate = F.when(F.col(names[i]) >= rank, inside).otherwise(estimate)
    return rows.select(*labels, "probability", F.when(F.col("_n") > 0, estimate).alias("estimate"))


def outcomes(validated: DataFrame, service: str) -> DataFrame:
    """Completed and failed rows; a failed row counts under the first rule it breaks."""
    error = F.try_element_at("failed_rules", F.lit(1))
    return validated.groupBy(
        F.lit(service).alias("service"),
        F.when(error.isNull(), "completed").otherwise("failed").alias("status"),
        F.coalesce(error, F.lit("none")).alias("error_type"),
    ).agg(F.count("*").alias("trips"))


def queue_lag(events: DataFrame, event_ts: str, ingest_ts: str) -> DataFrame:
    """Largest lag in seconds per minute of arrival."""
    lag = F.timestamp_diff("MICROSECOND", F.col(event_ts), F.col(ingest_ts)) / F.lit(1e6)
    return events.groupBy(F.date_trunc("minute", F.col(ingest_ts)).cast("timestamp_ntz").alias("step_ts")).agg(
        F.max(lag).alias("queue_lag_seconds")
    )


def rates(events: DataFrame, ts: str, amount: Column | None = None) -> DataFrame:
    """Per-second rates over sliding five-minute windows."""
    sums = {"_n": F.count("*")}
    if amount is not None:
        sums["_amount"] = fixed_sum(amount)
    rows = _over_windows(events, ts, sums)
    out = rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      (F.col("_n") / F.lit(RATE_SECONDS)).alias("events_per_second"),
                      *[(F.col(c) / F.lit(RATE_SECONDS)).alias("amount_per_second") for c in sums if c == "_amount"])
    return out


def _over_windows(events: DataFrame, ts: str, sums: dict[str, Column]) -> DataFrame:
    """Sums per sliding window: rows are combined per minute, and only minutes are copied into the windows that hold them."""
    minutes = events.where(F.col(ts).isNotNull()).groupBy(F.date_trunc("minute", F.col(ts)).cast(events.schema[ts].dataType).alias("_minute")).agg(*[c.alias(n) for n, c in sums.items()])
    totals = [(fixed_sum(F.col(n)) if n == "_amount" else F.sum(n)).alias(n) for n in sums]
    return minutes.groupBy(F.window("_minute", RATE_WINDOW, RATE_STEP).alias("w")).agg(*totals)


def held(breaching: DataFrame, rule: str, minutes: int, step: str = "step_ts") -> DataFrame:
    """Minutes at which a rule has been breached for ``minutes`` without a break.

    Each breaching minute supports itself and the following ones; a minute fires when all its
    ``minutes + 1`` supporters are there. The fan-out is fixed and nothing is ordered.
    """
    steps = breaching.select(step).distinct()
    supported = steps.select(F.explode(F.sequence(F.lit(0), F.lit(minutes))).alias("offset"), step).select(
        F.timestamp_add("MINUTE", "offset", F.col(step)).alias("fired_at")
    )
    return supported.groupBy("fired_at").agg(F.count("*").alias("support")).where(F.col("support") == minutes + 1) \
        .select(F.lit(rule).alias("alert"), "fired_at")


def alerts(lag: DataFrame, failures: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Firing minutes of the three rules: queue lag, failure rate, error share."""
    lagging = lag.where(F.col("queue_lag_seconds") > limits.lag_seconds)
    failing = failures.where(F.col("failures_per_second") > limits.failures_per_second)
    erring = failures.where(F.col("error_share") > limits.error_share)
    return (
        held(lagging, "processing_lag", limits.lag_minutes)
        .unionByName(held(failing, "quality_failures", limits.failure_minutes))
        .unionByName(held(erring, "error_share", limits.error_minutes))
    )


def failure_rate(events: DataFrame, ts: str, failed: Column) -> DataFrame:
    """Failures per second and share of failures over the five minutes before each minute."""
    rows = _over_windows(events, ts, {"_failed": count_if(failed), "_all": F.count("*")})
    return rows.select(
        F.col("w.end").alias("step_ts"),
        (F.col("_failed") / F.lit(RATE_SECONDS)).alias("failures_per_second"),
        # rates are per second and the divisor is at least 1 per second
        (F.col("_failed") / F.lit(RATE_SECONDS)
         / F.greatest(F.col("_all") / F.lit(RATE_SECONDS), F.lit(1.0))).alias("error_share"),
    )


def revenue_by_zone(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.col("pu_zone_id").alias("zone_id")).agg(
        fixed_sum(F.col("total_amount")).alias("revenue"), F.count("*").alias("visits"),
    )


def parse_logs(lines: DataFrame, column: str = "line") -> DataFrame:
    """Time, level, component and message of each line; NULLs for a line in another format."""
    line = F.col(column)
    matches = line.rlike(LOG_PATTERN)

    def group(i: int) -> Column:
        return F.when(matches, F.nullif(F.regexp_extract(line, LOG_PATTERN, i), F.lit("")))

    return lines.select(
        *lines.columns, group(1).alias("log_time"), group(2).alias("level"), group(3).alias("component"),
        group(4).alias("message"),
    )


def filter_level(logs: DataFrame, level: str = "ALL") -> DataFrame:
    return logs if level == "ALL" else logs.where(F.col("level") == level)


def log_volume(logs: DataFrame, ts: str, minutes: int = 5) -> DataFrame:
    """Lines per level and five minutes, and how many of them mention a warning or an error."""
    noisy = F.col("level").rlike("WARN|ERROR|CRITICAL|FATAL")
    window = F.window(ts, f"{minutes} minutes")
    rows = logs.groupBy(window.alias("w"), "level").agg(F.count("*").alias("lines"), count_if(noisy).alias("problem_lines"))
    return rows.select(F.col("w.start").alias("window_start"), "level", "lines", "problem_lines")


def parse_metric_lines(lines: DataFrame, order: str, column: str = "line") -> DataFrame:
    """Last value of each series (metric name with labels) by ``order``; comments, blanks and non-numbers are skipped."""
    parts = F.split(F.col(column), " ")
    rows = lines.where(~F.col(column).startswith("#") & (F.trim(column) != "") & (F.size(parts) >= 2))
    samples = rows.select(order, parts[0].alias("metric"), float_or_null(parts[1]).alias("value")).where("value is not null")
    return samples.groupBy("metric").agg(F.max_by("value", order).alias("value"), F.max(order).alias(order))


def metric_total(samples: DataFrame, name: str) -> DataFrame:
    """Sum of the series whose name contains ``name``; NULL when one of them is not finite."""
    return samples.where(F.col("metric").contains(name)).agg(fixed_sum(F.col("value")).alias("total"))

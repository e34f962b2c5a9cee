import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.operators.quantiles import MARGIN, approximate_quantiles, exact_quantiles, narrow
from meterline.plans import profiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]


def check(spark, values, partitions=8, **options):
    data = [(None if v is None else float(v),) for v in values]
    df = spark.createDataFrame(data, "x double").repartition(partitions)
    got = {r.probability: r.quantile for r in exact_quantiles(df, ["x"], PROBS, **options).collect()}
    want = np.quantile([v for v in values if v is not None], PROBS)
    assert [got[p] for p in PROBS] == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_continuous(spark):
    rng = np.random.default_rng(1)
    check(spark, np.concatenate([rng.lognormal(1, 2, 20_000), [1e12, -1e12]]).tolist())


def test_one_value_fills_a_third(spark):
    rng = np.random.default_rng(2)
    check(spark, np.concatenate([np.full(5_000, 2.5), rng.normal(0, 5, 10_000)]).tolist())


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [4.0, None, 1.0, None, 2.0, 3.0], [7.0] * 100])
def test_small(spark, values):
    check(spark, values, 3)


def test_sorted_input_where_partitions_differ(spark):
    df = spark.range(50_000).select(F.col("id").cast("double").alias("x"), (F.col("id") * -1).cast("double").alias("y"))
    got = {(r.metric, r.probability): r.quantile for r in exact_quantiles(df, ["x", "y"], [0.5, 0.99]).collect()}
    assert got == pytest.approx({("x", 0.5): 24999.5, ("x", 0.99): 49499.01, ("y", 0.5): -24999.5, ("y", 0.99): -499.99})


@pytest.mark.parametrize("most", [1, 50, 3_000])
def test_repeated_narrowing(spark, most):
    """Ties, heavy values and far ends, down to intervals of a single value."""
    rng = np.random.default_rng(5)
    check(spark, np.concatenate([np.full(3_000, 2.5), rng.normal(0, 5, 4_000), np.round(rng.normal(0, 5, 3_000), 1), [1e300, -1e300]]).tolist(), most=most)


def test_ordered_groups_are_bounded(spark):
    """All-distinct values: no interval that is ordered has more values than allowed, and few are ordered at all."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    totals, intervals, known = narrow(df, ["x"], PROBS, 1_000)
    assert totals == {"x": 200_000} and max(i.n for i in intervals) <= 1_000
    assert {r for i in intervals for r in i.ranks} | {r for _, r, _ in known} == {f(199_999 * p) for p in PROBS for f in (math.floor, math.ceil)}
    got = {r.probability: r.quantile for r in exact_quantiles(df, ["x"], PROBS, 1_000).collect()}
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile((np.arange(200_000) * 7919) % 200_003, PROBS)), rel=1e-12)


def test_empty_column(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    assert {r.metric for r in exact_quantiles(df, ["x", "y"], [0.5]).collect()} == {"x"}


def test_no_unpartitioned_window_or_cross_join(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    plan = exact_quantiles(df, ["x"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_approximate_form(spark):
    df = spark.range(1, 10_001).select(F.col("id").cast("double").alias("x"))
    got = {r.probability: r.quantile for r in approximate_quantiles(df, ["x"], [0.5, 0.9]).collect()}
    assert got[0.5] == pytest.approx(5000, rel=0.01) and got[0.9] == pytest.approx(9000, rel=0.01)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.exponential(10, 5_000), 3)
    df = spark.createDataFrame([(float(v),) for v in values], "fare_amount double")
    rows = profiles.histograms(df, {"fare_amount": 40.0}).orderBy("bin").collect()
    counts, _ = np.histogram(values[values <= 40], bins=50)
    assert sum(r.row_count for r in rows) == counts.sum()
    assert sum(abs(r.row_count - c) for r, c in zip(rows, counts)) <= 4  # values on an edge
    assert rows[0].median == pytest.approx(float(np.median(values)))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "fare_amount double")
    rows = [r for r in profiles.histograms(df, {"fare_amount": 40.0}).collect() if r.row_count]
    assert [(r.bin, r.row_count) for r in rows] == [(25, 4)]


def test_only_values_of_wanted_segments_are_shuffled(spark):
    """All-distinct values: no exchange by value before the segments are known, and few values reach one."""
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("x"))
    result = exact_quantiles(df, ["x"], [0.5])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(metric#" in plan and not re.search(r"hashpartitioning\(metric#\d+, value#", plan)
    assert 2 * MARGIN < 0.01 and result.count() == 1


def test_statistics_read_their_source_once(spark, tmp_path):
    """Rows that come out of a join are joined once, however many passes the quantiles take."""
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for rows in batches:
            calls.add(rows.num_rows)
            yield rows

    df = spark.range(1000).select(F.col("id").cast("double").alias("x")).mapInArrow(seen, "x double")
    for result in (profiles.statistics(df, ["x"], {0.5: "median"}), profiles.histograms(df, {"x": 500.0}), profiles.exact_quantiles(df, ["x"], [0.5])):
        before = calls.value
        result.collect()
        assert calls.value == before
    assert calls.value == 3 * 1000

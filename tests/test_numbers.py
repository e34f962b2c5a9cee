import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.functions.numeric import fixed_avg, fixed_sum, max_text
from meterline.functions.parsing import iso_timestamp
from meterline.operators.metrics import metric_total, parse_metric_lines

INF = float("inf")


@pytest.mark.parametrize("values, total, mean", [
    ([1e13, 1e13], 2e13, 1e13), ([0.1] * 10, 1.0, 0.1), ([-1.5, None, 4.0], 2.5, 1.25), ([None, None], None, None),
    ([1e18, -1e18, 3.0], 3.0, 1.0), ([float("nan"), 4.0], None, None), ([INF, 1.0], None, None), ([-INF, INF], None, None),
])
def test_fixed_sums(spark, values, total, mean):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = df.agg(fixed_sum(F.col("x")).alias("s"), fixed_avg(F.col("x")).alias("m")).first()
    assert row.s == (pytest.approx(total) if total is not None else None)
    assert row.m == (pytest.approx(mean) if mean is not None else None)


def test_last_sample_of_a_series_counts(spark):
    lines = [(1, 'hits{a="1"} 5'), (2, 'hits{a="2"} 7'), (3, 'hits{a="1"} 6'), (4, "# HELP hits"), (5, "hits none"), (6, "other 9")]
    samples = parse_metric_lines(spark.createDataFrame(lines, "n int, line string"), "n")
    assert {r.metric: r.value for r in samples.collect()} == {'hits{a="1"}': 6.0, 'hits{a="2"}': 7.0, "other": 9.0}
    assert metric_total(samples, "hits").first().total == 13.0


@pytest.mark.parametrize("odd", ["NaN", "+Inf", "-inf"])
def test_total_with_a_value_that_is_not_finite(spark, odd):
    lines = spark.createDataFrame([(1, 'hits{a="1"} 5'), (2, f'hits{{a="2"}} {odd}')], "n int, line string")
    assert metric_total(parse_metric_lines(lines, "n"), "hits").first().total is None


def test_times_need_a_date(spark):
    texts = ["10:30:00", "T10:30", "2025", "2025-01", "2025-01-02", "2025-01-02T03:04:05", "2025-01-02 03:04:05.5Z", "x", None]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "s string").select(iso_timestamp(F.col("s")).alias("t")).collect()]
    assert got == [None] * 4 + [dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 2, 3, 4, 5), dt.datetime(2025, 1, 2, 3, 4, 5, 500_000), None, None]


def test_greatest_text_of_few_groups_orders_no_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "c"), (1, None), (2, None)], "g int, t string")
    result = rows.groupBy("g").agg(max_text(F.col("t")).alias("t"))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    assert {r.g: r.t for r in result.collect()} == {1: "c", 2: None}

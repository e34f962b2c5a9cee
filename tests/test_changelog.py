import pytest
from pyspark.sql import functions as F, types as T

from meterline.sources import changelog
from meterline.sources.changelog import KeyedLog

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


@pytest.fixture
def log(tmp_path):
    return KeyedLog(str(tmp_path / "log"), SCHEMA, ("k",), buckets=16)


def rows(spark, **values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def content(log, spark):
    return {r.k: r.v for r in log.read(spark).collect()}


def size(folder):
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_last_append_counts_and_repeats_change_nothing(spark, log):
    assert content(log, spark) == {} and not log.exists(spark)
    assert log.append(spark, rows(spark, a=1, b=2), "d1") == 2
    assert log.append(spark, rows(spark, b=3, c=4), "d2") == 2
    assert log.append(spark, rows(spark, a=9), "d1") == 0
    assert content(log, spark) == {"a": 1, "b": 3, "c": 4}
    assert {r.k: r.v for r in log.of_keys(spark, rows(spark, a=0, c=0, z=0).select("k")).collect()} == {"a": 1, "c": 4}


def test_bytes_written_follow_the_change(spark, log, tmp_path):
    big = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    log.append(spark, big, "big")
    before = size(tmp_path)
    log.append(spark, rows(spark, **{str(i): -i for i in range(5)}), "small")
    assert size(tmp_path) - before < before / 50
    assert log.read(spark).agg(F.sum("v")).first()[0] == sum(range(50_000)) - 2 * sum(range(5))


def test_runs_are_merged_by_level(spark, log, monkeypatch, tmp_path):
    monkeypatch.setattr(changelog, "FAN", 3)
    want = {}
    for i in range(20):
        change = {f"k{(i * j) % 11}": 100 * i + j for j in range(4)}
        log.append(spark, rows(spark, **change), f"d{i}")
        want.update(change)
        assert content(log, spark) == want
    runs = log.manifest(spark)["runs"]
    assert len(runs) <= 6 and max(r["level"] for r in runs) == 2
    # runs that no manifest in use names are gone
    kept = {p.name for p in (tmp_path / "log" / "runs").iterdir()}
    assert kept == {r["name"] for r in runs} | set(log.manifest(spark)["retired"])


def test_a_run_without_manifest_does_not_count(spark, log):
    """A writer lost before it published leaves nothing to see, and its repeat does the work."""
    log.append(spark, rows(spark, a=1), "d1")
    half = rows(spark, a=2).withColumns({"_bucket": log.bucket(), "_seq": F.lit(2).cast("bigint")})
    log._write(half, f"{log.path}/runs/d2")
    assert content(log, spark) == {"a": 1}
    assert log.append(spark, rows(spark, a=2), "d2") == 1 and content(log, spark) == {"a": 2}


def test_dead_rows_are_not_read_and_leave_with_a_merge(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(changelog, "FAN", 2)
    log = KeyedLog(str(tmp_path / "log"), SCHEMA, ("k",), alive=lambda: F.col("v") >= 10)
    log.append(spark, rows(spark, a=1, b=20), "d1")
    assert content(log, spark) == {"b": 20}
    log.append(spark, rows(spark, b=5, c=30), "d2")
    assert content(log, spark) == {"c": 30}
    assert spark.read.parquet(*[f"{log.path}/runs/{r['name']}" for r in log.manifest(spark)["runs"]]).count() == 1


def test_only_touched_buckets_are_read(spark, log):
    log.append(spark, spark.range(2000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")), "d1")
    plan = log.read(spark, [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "In(_bucket, [3,5])" in plan


def test_reading_needs_no_sorted_aggregate(spark, log):
    log.append(spark, rows(spark, a=1), "d1")
    log.append(spark, rows(spark, a=2), "d2")
    assert "SortAggregate" not in log.read(spark)._jdf.queryExecution().executedPlan().toString()

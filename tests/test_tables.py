import datetime as dt
import shutil

from pyspark.sql import functions as F

from meterline.operators import kpis
from meterline.operators.upsert import latest_per_key
from meterline.schemas import COMPLETE_TRIP
from meterline.sources.tables import mart_table, path_exists, staging_table

D = dt.datetime


def trips(spark, *rows):
    """(key, pickup, total) as staging rows."""
    full = [(k, 1, p, p + dt.timedelta(minutes=9), 1, 2, 1, 1.0, 1.0, 0.0, float(t), 1, "veh", "test", p, p) for k, p, t in rows]
    return spark.createDataFrame(full, COMPLETE_TRIP)


def content(table, spark):
    return {r.trip_key: (r.pickup_ts, r.total_amount) for r in table.read(spark).collect()}


def test_upsert_inserts_replaces_and_is_repeatable(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    assert table.read(spark).count() == 0
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2)), "s1-1")
    second = trips(spark, ("a", D(2025, 1, 1), 9), ("c", D(2025, 1, 3), 3))
    for _ in range(2):
        table.upsert(spark, second, "s1-2")
        assert content(table, spark) == {"a": (D(2025, 1, 1), 9.0), "b": (D(2025, 1, 2), 2.0), "c": (D(2025, 1, 3), 3.0)}


def test_row_moves_to_another_partition(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2), ("c", D(2025, 1, 2), 3)), "s2-1")
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 5), 7), ("b", D(2025, 1, 5), 8)), "s2-2")
    assert content(table, spark) == {"a": (D(2025, 1, 5), 7.0), "b": (D(2025, 1, 5), 8.0), "c": (D(2025, 1, 2), 3.0)}
    assert not (tmp_path / "t" / "pickup_day=2025-01-01").exists()


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2)), "s3-1")
    before = sorted(p.name for p in (tmp_path / "t" / "pickup_day=2025-01-01").glob("*.parquet"))
    table.upsert(spark, trips(spark, ("b", D(2025, 1, 2), 5)), "s3-2")
    assert sorted(p.name for p in (tmp_path / "t" / "pickup_day=2025-01-01").glob("*.parquet")) == before


def test_interrupted_publish_is_completed(spark, tmp_path):
    """A partition lost between removal and replacement comes back whole."""
    table = staging_table(str(tmp_path / "t"))
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 1), 2)), "s4-1")
    update = trips(spark, ("b", D(2025, 1, 1), 5))
    stage = table.stage_path("s4-2")
    table._stage(spark, update, (), stage)
    shutil.rmtree(tmp_path / "t" / "pickup_day=2025-01-01")
    table.upsert(spark, update, "s4-2")
    assert content(table, spark) == {"a": (D(2025, 1, 1), 1.0), "b": (D(2025, 1, 1), 5.0)}
    assert path_exists(spark, f"{stage}/published") and not path_exists(spark, f"{stage}/merged")


def test_delivery_belongs_to_its_table(spark, tmp_path):
    """One delivery name for two tables, and for a table that was removed and built again."""
    one, two = staging_table(str(tmp_path / "one")), staging_table(str(tmp_path / "two"))
    rows = trips(spark, ("a", D(2025, 1, 1), 1))
    assert [t.upsert(spark, rows, "load-2025-01") for t in (one, two, one)] == [1, 1, 0]
    assert one.read(spark).count() == two.read(spark).count() == 1
    shutil.rmtree(tmp_path / "one")
    assert one.upsert(spark, rows, "load-2025-01") == 1 and one.read(spark).count() == 1


def test_keys_that_hold_the_day_need_no_look_at_the_table(spark, tmp_path):
    """Nor do other keys: their days come from the buckets of the index."""
    rows = trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2)).withColumn("pickup_day", F.to_date("pickup_ts"))
    for holds in (True, False):
        table = staging_table(str(tmp_path / f"t{holds}"), holds)
        table.upsert(spark, rows.drop("pickup_day"), "s8-1")
        update = spark.createDataFrame(rows.where("trip_key = 'b'").collect(), rows.schema)
        plan = table._touched(spark, update)._jdf.queryExecution().executedPlan().toString()
        assert "pickup_day=" not in plan and f"t{holds}/pickup" not in plan
        assert plan.count("FileScan") == (0 if holds else 1)
        if not holds:
            bucket = update.select(table.index.bucket()).first()[0]
            assert f"EqualTo(_bucket,{bucket})" in plan or f"In(_bucket, [{bucket}])" in plan
        table.upsert(spark, update.drop("pickup_day"), "s8-2")
        assert table.read(spark).count() == 2
        assert path_exists(spark, f"{table.path}/_index") == (not holds)


def test_days_are_written_once(spark, tmp_path):
    """The published files are those of the staged copy."""
    table = staging_table(str(tmp_path / "t"))
    update = trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2))
    table._stage(spark, update, (), table.stage_path("s10-1"))
    staged = {p.name for p in (tmp_path / "t").glob("_deliveries/s10-1/merged/*/*.parquet")}
    table.upsert(spark, update, "s10-1")
    assert staged and {p.name for p in (tmp_path / "t").glob("pickup_day=*/*.parquet")} == staged


def test_index_follows_moves_and_is_built_for_older_tables(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    for i, day in enumerate((1, 5, 3)):
        table.upsert(spark, trips(spark, ("a", D(2025, 1, day), i), (f"x{i}", D(2025, 1, day), i)), f"s11-{i}")
        assert content(table, spark)["a"] == (D(2025, 1, day), float(i)) and table.read(spark).count() == i + 2
    days = {r.trip_key: r.pickup_day.day for r in table.index.read(spark).collect()}
    assert days == {"a": 3, "x0": 1, "x1": 5, "x2": 3}
    shutil.rmtree(tmp_path / "t" / "_index")
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 9), 9)), "s11-9")
    assert content(table, spark)["a"] == (D(2025, 1, 9), 9.0) and table.read(spark).count() == 4


def test_interrupted_after_some_renames(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2)), "s12-1")
    update = trips(spark, ("a", D(2025, 1, 2), 3), ("c", D(2025, 1, 3), 4))
    stage = tmp_path / "t" / "_deliveries" / "s12-2"
    table._stage(spark, update, (), str(stage))
    shutil.rmtree(tmp_path / "t" / "pickup_day=2025-01-02")
    (stage / "merged" / "pickup_day=2025-01-02").rename(tmp_path / "t" / "pickup_day=2025-01-02")
    table.upsert(spark, update, "s12-2")
    assert content(table, spark) == {"a": (D(2025, 1, 2), 3.0), "b": (D(2025, 1, 2), 2.0), "c": (D(2025, 1, 3), 4.0)}
    assert not (tmp_path / "t" / "pickup_day=2025-01-01").exists()


def test_lookup_by_key(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2)), "s9-1")
    assert [r.total_amount for r in table.lookup(spark, "b").collect()] == [2.0]
    assert table.lookup(spark, "b", day=dt.date(2025, 1, 1)).isEmpty() and table.lookup(spark, "z").isEmpty()
    plan = table.lookup(spark, "b", day=dt.date(2025, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(trip_key), EqualTo(trip_key,b)]" in plan


def test_last_write_wins_inside_a_batch(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    batch = trips(spark, ("a", D(2025, 1, 1), 5), ("a", D(2025, 1, 1), 3)).withColumn(
        "seq", F.when(F.col("total_amount") == 3, 2).otherwise(1))
    table.upsert(spark, batch, "s5-1", ["seq"])
    assert content(table, spark) == {"a": (D(2025, 1, 1), 3.0)}


def test_only_repeated_keys_are_ordered(spark, tmp_path):
    """Rows whose key comes once go from the delivery to the table without a sort or a shuffle of their own."""
    table = staging_table(str(tmp_path / "t"))
    batch = trips(spark, *[(f"k{i % 90}", D(2025, 1, 1 + i % 3), i) for i in range(100)])
    stage = table.stage_path("s13-1")
    table._stage(spark, batch, (), stage)
    assert spark.read.parquet(f"{stage}/winners").count() == spark.read.parquet(f"{stage}/repeated").count() == 10
    plan = table._update(spark, stage)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert table.upsert(spark, batch, "s13-1") == 90
    want = {r.trip_key: (r.pickup_ts, r.total_amount) for r in latest_per_key(batch, ["trip_key"]).collect()}
    assert content(table, spark) == want


def test_hot_key_collapses_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"), F.col("id").alias("v"))
    latest = latest_per_key(df, ["k"], ["seq"])
    assert latest.collect() == [("hot", 99_999, 99_999)]
    assert "partial_max" in latest._jdf.queryExecution().executedPlan().toString()


def test_mart_keeps_keys_outside_the_range(spark, tmp_path):
    staged, mart = staging_table(str(tmp_path / "s")), mart_table(str(tmp_path / "m"))
    staged.upsert(spark, trips(spark, *[(f"k{d}", D(2025, 1, d, 5), d) for d in range(1, 6)]), "s6-1")
    full = kpis.kpi_full_refresh(staged.read(spark))
    mart.upsert(spark, kpis.mart_rows(full, D(2025, 2, 1)), "s6-1")
    within = kpis.backfill_range(D(2025, 1, 2), D(2025, 1, 3))
    part = kpis.zone_hourly_kpis(staged.read_days(spark, dt.date(2025, 1, 2), dt.date(2025, 1, 3)), within)
    mart.upsert(spark, kpis.mart_rows(part, D(2025, 2, 2)), "s6-2")
    rows = {r.hour_ts.day: r.created_at.day for r in mart.read(spark).collect()}
    assert rows == {1: 1, 2: 2, 3: 2, 4: 1, 5: 1}


def test_day_range_prunes_partitions(spark, tmp_path):
    table = staging_table(str(tmp_path / "t"))
    table.upsert(spark, trips(spark, ("a", D(2025, 1, 1), 1), ("b", D(2025, 1, 2), 2)), "s7-1")
    plan = table.read_days(spark, dt.date(2025, 1, 2), dt.date(2025, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_day" in plan


def test_mostly_repeated_keys_are_reduced_once(spark, tmp_path):
    """When most rows have a key that comes again, the reduced rows are the whole update: nothing is joined with the delivery again."""
    table = staging_table(str(tmp_path / "t"), keys_hold_time=True)
    batch = trips(spark, *[(f"k{i % 40}", D(2025, 1, 1 + i % 4), i) for i in range(80)])
    stage = table.stage_path("twice")
    table._stage(spark, batch, (), stage)
    plan = table._update(spark, stage)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert table.upsert(spark, batch, "twice") == 40
    want = {r.trip_key: (r.pickup_ts, r.total_amount) for r in latest_per_key(batch, ["trip_key"]).collect()}
    assert content(table, spark) == want

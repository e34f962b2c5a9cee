import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterline.operators import quality
from meterline.plans import pipeline
from meterline.sources import files, listing, topics, zones
from meterline.sources.tables import mart_table, staging_table

D = dt.datetime


def write_month(spark, root, year, month, rows, **extra):
    """(minutes after midnight, miles, total) as one raw monthly file."""
    start = D(year, month, 3)
    data = [(1, start + dt.timedelta(minutes=m), start + dt.timedelta(minutes=m + 10), 1.0, miles, 1.0, "N", 1, 2, 1, 5.0, 1.0,
             0.0, total) for m, miles, total in rows]
    df = spark.createDataFrame(data, (
        "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
        "trip_distance double, RatecodeID double, store_and_fwd_flag string, PULocationID int, DOLocationID int, "
        "payment_type int, fare_amount double, tip_amount double, tolls_amount double, total_amount double"))
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    folder = root / "yellow" / f"{year}" / f"{month:02d}"
    folder.mkdir(parents=True)
    df.coalesce(1).toPandas().to_parquet(folder / f"yellow_tripdata_{year}-{month:02d}.parquet", coerce_timestamps="us")


@pytest.fixture
def raw_root(spark, tmp_path):
    write_month(spark, tmp_path, 2025, 1, [(0, 1.0, 7.0), (20, 2.0, -7.0), (40, float("nan"), 7.0)])
    write_month(spark, tmp_path, 2025, 2, [(0, 1.0, 7.0), (30, 400.0, 7.0)], Airport_fee=1.25, cbd_congestion_fee=0.75)
    return tmp_path


def test_missing_month_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_raw_month(spark, str(tmp_path / "none.parquet"))


def test_months_merge_by_name(spark, raw_root):
    raw = files.read_all_months(spark, str(raw_root))
    assert {(r.month, r.n, r.fee, r.cbd) for r in raw.groupBy("month").agg(
        F.count("*").alias("n"), F.max("Airport_fee").alias("fee"), F.max("cbd_congestion_fee").alias("cbd")).collect()} == {
        (1, 3, None, None), (2, 2, 1.25, 0.75)}
    assert sorted(r.row_offset for r in raw.where("month = 1").collect()) == [0, 1, 2]
    assert raw.where("trip_distance is null").count() == 1


def test_discover_and_pending(spark, raw_root):
    months = files.discover_months(spark, str(raw_root))
    assert [(r.year, r.month) for r in months.orderBy("month").collect()] == [(2025, 1), (2025, 2)]
    done = spark.createDataFrame([(2025, 1)], "year int, month int")
    assert [r.month for r in files.pending_months(months, done).collect()] == [2]
    assert files.pending_months(months, done, force=True).count() == 2
    newest = files.latest_file(files.list_files(spark, str(raw_root), "*.parquet")).first()
    assert newest.path.endswith("yellow_tripdata_2025-02.parquet")


def test_pipeline_from_files_to_mart(spark, raw_root, tmp_path):
    curated = str(tmp_path / "curated")
    taken = pipeline.curate_months(spark, str(raw_root), curated)
    assert taken == 2
    rows = files.read_curated(spark, curated)
    assert {(r.year, r.month): r["count"] for r in rows.groupBy("year", "month").count().collect()} == {(2025, 1): 2, (2025, 2): 1}
    assert pipeline.curate_months(spark, str(raw_root), curated) == 0
    dim = spark.createDataFrame([(1, "A", "a", "s"), (2, "B", "b", "s")], "zone_id int, borough string, zone_name string, service_zone string")
    staged, mart = staging_table(str(tmp_path / "stg")), mart_table(str(tmp_path / "mart"))
    for run in ("load-1", "load-2"):
        pipeline.load_staging(spark, rows, dim, staged, "salt", D(2025, 3, 1), run)
        assert staged.read(spark).count() == 3
    stats = pipeline.refresh_kpis(spark, staged, mart, D(2025, 3, 2), "kpi-1").first()
    assert (stats.hours_processed, stats.zones_affected) == (2, 1)


def test_overwrite_keeps_other_months(spark, raw_root, tmp_path):
    curated = str(tmp_path / "curated")
    pipeline.curate_months(spark, str(raw_root), curated)
    february = files.read_raw_month(spark, str(raw_root / "yellow/2025/02/*.parquet"))
    files.write_curated(quality.curate(february).limit(0).unionByName(quality.curate(february)), curated)
    assert files.read_curated(spark, curated).count() == 3


def test_zone_file_and_fallback(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n2,Queens,Jamaica Bay,Boro Zone\n')
    dim = zones.read_zone_csv(spark, str(path))
    assert dim.collect() == [(1, "EWR", "Newark, Airport", "EWR"), (2, "Queens", "Jamaica Bay", "Boro Zone")]
    fallback = zones.fallback_zones(spark)
    assert fallback.count() == 5
    assert zones.seed_zones(fallback, dim).count() == 0
    assert zones.seed_zones(fallback.limit(0), dim).count() == 2


def test_suspicious_downloads(spark, tmp_path):
    (tmp_path / "ok.parquet").write_bytes(b"404" + b"x" * 2000)
    (tmp_path / "denied.parquet").write_text("<Error>Access Denied</Error>")
    (tmp_path / "empty.parquet").write_bytes(b"")
    (tmp_path / "short.parquet").write_bytes(b"PAR1 short but fine")
    found = {r.path.rsplit("/", 1)[1]: r.reason for r in files.suspicious_downloads(spark, str(tmp_path)).collect()}
    assert found == {"denied.parquet": "error_page", "empty.parquet": "empty"}


def test_nested_downloads_are_listed_by_tasks(spark, tmp_path):
    """Files of every depth, whatever their names; the paths are those that the file source gives."""
    for folder in ("", "a", "a/b=1", "a/b=1/c d", "e%20f"):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "empty.parquet").write_bytes(b"")
        (tmp_path / folder / "page.parquet").write_text("<Error>Access Denied</Error>")
    (tmp_path / "hollow").mkdir()
    found = files.suspicious_downloads(spark, str(tmp_path))
    assert found.groupBy("reason").count().orderBy("reason").collect() == [("empty", 5), ("error_page", 5)]
    seen = listing.list_tree(spark, str(tmp_path))
    assert seen.where("folder").count() == 5 and seen.where("length = 0").count() == 5
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    assert {r.path for r in source.select("path").collect()} == {
        r.path for r in seen.where("NOT folder AND length > 0").collect()}
    assert listing.list_tree(spark, str(tmp_path / "hollow")).isEmpty()
    assert listing.list_tree(spark, str(tmp_path / "absent")).isEmpty()


def test_first_rows_follow_file_order(spark, raw_root):
    raw = files.read_raw_month(spark, str(raw_root / "yellow/2025/01/*.parquet"))
    assert [r.row_offset for r in files.first_rows(raw, 2, "row_offset").collect()] == [0, 1]


def test_messages_and_envelope(spark):
    events = spark.createDataFrame([("k1", 5)], "trip_key string, vendor_id int")
    assert topics.to_messages(events).collect() == [("k1", '{"trip_key":"k1","vendor_id":5}')]
    kafka = spark.createDataFrame([("t", 0, 7, bytearray(b"k1"), bytearray(b"{}"), D(2025, 1, 1))],
                                  "topic string, partition int, offset bigint, key binary, value binary, timestamp timestamp_ntz")
    row = topics.envelope(kafka).first()
    assert (row.topic, row.partition, row.offset, row.key, row.value) == ("t", 0, 7, "k1", "{}")


def test_sent_and_rejected_messages_are_counted(spark, tmp_path):
    rows = [("a", "{}"), ("b", None), (None, "{}"), (None, None), ("c", "x" * 200), ("d", "é" * 40), ("e", "y")]
    messages = spark.createDataFrame(rows, "key string, value string").repartition(3)
    counts = topics.send(messages, lambda sent: sent.write.parquet(str(tmp_path / "out")), most_bytes=100)
    assert (counts.sent, counts.rejected, counts.failed) == (3, {"no_value": 2, "no_key": 1, "too_large": 1}, 4)
    assert {r.key for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"a", "d", "e"}
    none = topics.send(messages.limit(0), lambda sent: sent.write.parquet(str(tmp_path / "none")))
    assert (none.sent, none.failed) == (0, 0)


def test_a_stream_of_messages_is_counted(spark, tmp_path):
    folder, counts = str(tmp_path / "in"), topics.SinkCounts()
    for i in range(3):
        spark.createDataFrame([(f"k{i}", "v"), (None, "v")], "key string, value string").coalesce(1).write.mode("append").parquet(folder)
    query = topics.start_send(topics.read_message_files(spark, folder, 1), str(tmp_path / "c"),
                              lambda sent, epoch: sent.write.mode("overwrite").parquet(str(tmp_path / "out" / f"epoch={epoch}")), counts)
    assert query.awaitTermination(120) and query.exception() is None
    assert (counts.sent, counts.rejected) == (3, {"no_key": 3})
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3

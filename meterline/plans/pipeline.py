"""End-to-end batch runs: raw months to curated files, staging table and KPI mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.operators import kpis, ledger, quality, staging
from meterline.sources import files
from meterline.sources.store import remove_path, touch
from meterline.sources.tables import KeyedTable


def curate_months(spark: SparkSession, data_root: str, curated_path: str, force: bool = False) -> int:
    """Curate the raw months that are not done; returns how many were taken.

    Only the list of month files, one path each, comes to the driver. All months are one job. A month
    is done when its marker is there, also when no row of it was good, so no curated row is read to
    find out. What a month held before goes before it is written again: it may have no row now.
    """
    discovered = files.discover_months(spark, data_root)
    done = spark.createDataFrame(files.done_months(spark, curated_path), "year int, month int")
    pending = files.pending_months(discovered, done, force)
    months = pending.select("path", "year", "month").orderBy("path").collect()
    for m in months:
        remove_path(spark, files.done_marker(curated_path, m.year, m.month))
        remove_path(spark, f"{curated_path}/year={m.year}/month={m.month}")
    if months:
        raw = spark.read.option("mergeSchema", "true").parquet(*[m.path for m in months])
        files.write_curated(quality.curate(files.with_source_columns(raw)), curated_path)
    for m in months:
        touch(spark, files.done_marker(curated_path, m.year, m.month))
    return len(months)


def load_staging(spark: SparkSession, curated: DataFrame, zones: DataFrame, table: KeyedTable, salt: str,
                 as_of: dt.datetime, batch_id: str, source: str = "batch") -> dict[str, int]:
    """Key, validate and check curated trips, then upsert them; returns rows rejected and keys upserted.

    Rejected rows are kept with their reason beside the table, in ``rejects_path``.
    """
    judged = staging.judged_trips(curated, zones, salt, source, as_of)
    rejects = rejects_path(table, batch_id)
    judged.where("reject_reason is not null").write.mode("overwrite").parquet(rejects)
    taken = table.upsert(spark, judged.where("reject_reason is null").select(*table.schema.names), batch_id)
    return {"rejected": spark.read.parquet(rejects).count(), "upserted": taken}


def rejects_path(table: KeyedTable, batch_id: str) -> str:
    return f"{table.path}/_rejects/{batch_id}"


def refresh_kpis(spark: SparkSession, trips: KeyedTable, mart: KeyedTable, as_of: dt.datetime, batch_id: str,
                 within: kpis.TimeRange | None = None) -> DataFrame:
    """Recompute KPIs, all or those of a time range, and upsert them; returns the run statistics.

    Keys without a new value stay. A range reads only the days it covers.
    """
    if within is None:
        rows = trips.read(spark)
    else:
        rows = trips.read_days(spark, within.start.date(), within.end.date())
    computed = kpis.zone_hourly_kpis(rows, within)
    mart.upsert(spark, kpis.mart_rows(computed, as_of), batch_id)
    written = mart.read(spark).where(F.col("created_at") == staging.timestamp_literal(as_of))
    return kpis.kpi_run_stats(written if within is None else written.where(within.contains("hour_ts")))


def refresh_changed_kpis(spark: SparkSession, trips: KeyedTable, sums: KeyedTable, mart: KeyedTable, as_of: dt.datetime,
                         batch_id: str) -> int:
    """Bring KPIs up to date with one delivery to ``trips`` (a table with ``keep_changes``); returns the KPI rows written.

    Only what the delivery changed is read of the trips, and only the touched days of the ledger ``sums``. The order of
    deliveries does not matter, and taking one again changes nothing. As with a full refresh, a zone and hour that has
    lost its last trip keeps its old mart row. Changes may be forgotten once this has returned.
    """
    delta_path = f"{sums.path}/_deltas/{batch_id}"
    ledger.contributions(trips.changes(spark, batch_id)).write.mode("overwrite").parquet(delta_path)
    delta = spark.read.schema(sums.schema).parquet(delta_path)
    days = [r[0] for r in delta.select(F.to_date("hour_ts")).distinct().collect()]
    sums.upsert(spark, ledger.add(sums.read_partitions(spark, days), delta), batch_id)
    hours = delta.select(*ledger.HOUR).distinct()
    touched = sums.read_partitions(spark, days).join(hours, list(ledger.HOUR), "left_semi")
    written = mart.upsert(spark, kpis.mart_rows(ledger.ledger_kpis(touched), as_of), batch_id)
    remove_path(spark, delta_path)
    return written

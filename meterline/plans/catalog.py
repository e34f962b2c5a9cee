"""Registered queries: every operator over the whole star-schema tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.functions import parsing
from meterline.functions.numeric import max_text
from meterline.functions.rows import once
from meterline.operators import events as ev
from meterline.operators import kpis, metrics, quality, staging, state, validation
from meterline.operators.upsert import latest_per_key
from meterline.plans import pipeline, profiles, reports
from meterline.schemas import BATCH_SIZE_BUCKETS, LATENCY_BUCKETS
from meterline.session import configure, configure_store, work_dir
from meterline.sources import files, star, zones
from meterline.sources.store import saved
from meterline.sources.tables import kpi_ledger, mart_table, staging_table
from meterline.streaming.assembly import read_rejects, start_assembly
from meterline.streaming.fields import field_store, start_field_state

SALT = "meterline"
AS_OF = dt.datetime(2025, 2, 1)
ARRIVAL = ("seq_ts", "seq_id")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Inputs:
    """The tables a query works on; each is built only when used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return star.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return star.raw_trips(self.spark, self.sf_dir)

    @cached_property
    def derived(self) -> DataFrame:
        return quality.derived_fields(self.raw)

    @cached_property
    def curated(self) -> DataFrame:
        return quality.curate(self.raw)

    @cached_property
    def records(self) -> DataFrame:
        return staging.to_complete_trip(self.curated, SALT, "batch", AS_OF)

    @cached_property
    def validated(self) -> DataFrame:
        return validation.validate(self.records, validation.complete_rules())

    @cached_property
    def staged(self) -> DataFrame:
        return staging.stage_trips(self.curated, SALT, "batch", AS_OF)

    @cached_property
    def zones(self) -> DataFrame:
        return zones.standardize_zones(star.zone_file(self.spark, self.sf_dir))

    @cached_property
    def kpis(self) -> DataFrame:
        return kpis.zone_hourly_kpis(self.staged)

    @cached_property
    def events(self) -> DataFrame:
        return star.stream_events(self.table("events")).withColumn("event_ts", F.col("seq_ts"))

    @cached_property
    def state(self) -> DataFrame:
        return state.trip_state(self.events, ARRIVAL_OF_EVENTS)

    @cached_property
    def stream_trips(self) -> DataFrame:
        return state.assembled_trips_full(self.state, AS_OF)

    @cached_property
    def messages(self) -> DataFrame:
        return star.event_messages(self.table("events"))

    @cached_property
    def parsed(self) -> DataFrame:
        return ev.parse_messages(self.messages)

    @cached_property
    def logs(self) -> DataFrame:
        return metrics.parse_logs(star.log_lines(self.spark, self.sf_dir))


# seq_id is the numeric event id; the text id orders differently within one instant
ARRIVAL_OF_EVENTS = ("event_ts", "seq_id")


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under the name of its function."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Inputs(configure_store(configure(spark)), sf_dir))
    QUERIES[build.__name__] = run
    return build


def month(ts: str):
    return F.date_format(ts, "yyyy-MM")


def joined(column: str):
    return F.array_join(column, ",")


# ------------------------------------------------------------- sources, sinks


@query
def curate_pending_months(t: Inputs) -> DataFrame:
    """Months with orders but without events: the months of the events count as curated."""
    def path(ts: str):
        return F.concat(F.lit("raw/yellow/"), F.date_format(ts, "yyyy/MM/"), F.lit("yellow_tripdata_"), month(ts), F.lit(".parquet"))
    raw = files.months_from_paths(t.table("orders").select(path("o_orderdate").alias("path")).distinct())
    done = files.months_from_paths(t.table("events").select(path("ts").alias("path")).distinct())
    return files.pending_months(raw, done).select("path", "year", "month")


@query
def curate_sample(t: Inputs) -> DataFrame:
    """The first rows of a file, curated."""
    first = files.first_rows(t.raw, 1000, "row_offset", "trip_distance", PICKUP, "DOLocationID", "tip_amount")
    return quality.curate(first).select(*CURATED_COLUMNS)


PICKUP = quality.PICKUP
CURATED_COLUMNS = (
    "row_offset", "vendor_id", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance", "rate_code",
    "store_and_fwd_flag", "pu_zone_id", "do_zone_id", "payment_type", "fare_amount", "tip_amount",
    "tolls_amount", "total_amount", "congestion_surcharge", "airport_fee", "distance_km", "duration_min",
    "avg_speed_kmh",
)


@query
def load_zones(t: Inputs) -> DataFrame:
    """Rows to insert into an empty dimension, and into one that is filled already (none)."""
    candidate = zones.standardize_zones(star.zone_file(t.spark, t.sf_dir))
    empty, filled = zones.seed_zones(t.zones.limit(0), candidate), zones.seed_zones(t.zones, candidate)
    return empty.withColumn("target", F.lit("empty")).unionByName(filled.withColumn("target", F.lit("filled")))


def _upsert_sides(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """A first load of ten days, and a later delivery of the last seven that corrects it twice."""
    first = t.staged.where(F.to_date("pickup_ts") <= F.lit("2025-01-10").cast("date"))
    late = t.staged.where(F.to_date("pickup_ts") >= F.lit("2025-01-08").cast("date"))
    versions = late.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
    update = versions.withColumns({
        "source": F.concat(F.lit("stream-"), F.col("seq").cast("string")),
        "total_amount": F.col("total_amount") + F.col("seq"),
    })
    return first, update


def _run_folder(t: Inputs) -> str:
    return f"{work_dir(t.spark)}/tables/{uuid.uuid4()}"


def _upserted_trips(t: Inputs) -> DataFrame:
    """A stored table after both deliveries."""
    first, update = _upsert_sides(t)
    stored = staging_table(f"{_run_folder(t)}/trips", keys_hold_time=True)
    stored.upsert(t.spark, first, "first")
    stored.upsert(t.spark, update, "late", ["seq"])
    return stored.read(t.spark)


@query
def upsert_trips(t: Inputs) -> DataFrame:
    return _upserted_trips(t)


@query
def upsert_kpis(t: Inputs) -> DataFrame:
    stored = mart_table(f"{_run_folder(t)}/kpis")
    # both deliveries read the trips twice, for measures and for vehicles
    both = kpis.backfill_range(dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 14))
    trips = saved(t.staged.where(both.contains("pickup_ts")).select(*kpis.TRIP_COLUMNS), "kpi-trips")
    first = kpis.kpi_backfill(trips, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 10))
    stored.upsert(t.spark, kpis.mart_rows(first, AS_OF), "first")
    corrected = trips.withColumn("fare_amount", F.col("fare_amount") * 2)
    update = kpis.kpi_backfill(corrected, dt.datetime(2025, 1, 8), dt.datetime(2025, 1, 14))
    stored.upsert(t.spark, kpis.mart_rows(update, AS_OF), "corrected")
    return stored.read(t.spark).select("zone_id", "hour_ts", "trips", "unique_vehicles", *_as_doubles(MART_MEASURES))


@query
def kpi_changed_refresh(t: Inputs) -> DataFrame:
    """The mart after two deliveries of trips, the second of which corrects fares, zones and vehicles of the first."""
    folder = _run_folder(t)
    trips = staging_table(f"{folder}/trips", keys_hold_time=True, keep_changes=True)
    sums, mart = kpi_ledger(f"{folder}/sums"), mart_table(f"{folder}/kpis")
    half = F.pmod(F.xxhash64("trip_key"), F.lit(2)) == 0
    wrong = t.staged.where("pickup_ts < timestamp_ntz'2025-01-10 00:00:00'").withColumns({
        "fare_amount": F.when(half, F.col("fare_amount") * 3).otherwise(F.col("fare_amount")),
        "payment_type": F.when(half, F.lit(9)).otherwise(F.col("payment_type")),
        "vehicle_id_h": F.when(half, F.lit("unknown")).otherwise(F.col("vehicle_id_h")),
    })
    right = t.staged.where(half | (F.col("pickup_ts") >= staging.timestamp_literal(dt.datetime(2025, 1, 10))))
    for batch, rows in (("wrong", wrong), ("right", right)):
        trips.upsert(t.spark, rows, batch)
        pipeline.refresh_changed_kpis(t.spark, trips, sums, mart, AS_OF, batch)
        trips.forget_changes(t.spark, batch)
    return mart.read(t.spark).select("zone_id", "hour_ts", "trips", "unique_vehicles", *_as_doubles(MART_MEASURES))


def _as_doubles(columns) -> list:
    return [F.col(c).cast("double").alias(c) for c in columns]


MART_MEASURES = ("avg_fare", "avg_tip", "avg_speed_kmh", "avg_distance_km", "avg_duration_min", "pct_card")


@query
def trips_first_n(t: Inputs) -> DataFrame:
    return staging.first_trips(_one_per_key(t.staged), 100)


def _one_per_key(trips: DataFrame) -> DataFrame:
    return latest_per_key(trips, ["trip_key"])


# ---------------------------------------------------------------- projections


@query
def derived_fields(t: Inputs) -> DataFrame:
    return t.derived.select("row_offset", PICKUP, "trip_distance", "distance_km", "duration_min", "avg_speed_kmh")


@query
def derived_ranges(t: Inputs) -> DataFrame:
    return quality.derived_ranges(t.derived)


@query
def standardize_columns(t: Inputs) -> DataFrame:
    return quality.standardize_columns(t.raw).select(*[c for c in CURATED_COLUMNS if c not in quality.DERIVED])


@query
def trip_keys(t: Inputs) -> DataFrame:
    keyed = staging.with_trip_keys(quality.standardize_columns(t.raw), SALT)
    return keyed.select("row_offset", "vendor_id", "pickup_ts", "pu_zone_id", "trip_key")


@query
def vehicle_ids(t: Inputs) -> DataFrame:
    keyed = staging.with_trip_keys(quality.standardize_columns(t.raw), SALT)
    return keyed.groupBy("vehicle_id_h").agg(F.count("*").alias("trips"), F.min("row_offset").alias("first_row"))


@query
def to_complete_trip(t: Inputs) -> DataFrame:
    return t.records


@query
def trip_properties(t: Inputs) -> DataFrame:
    return staging.trip_properties(t.staged)


@query
def safe_parse(t: Inputs) -> DataFrame:
    """Text that is sometimes a number: priorities, their first character, decimal and whole prices."""
    orders = t.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    texts = once(orders, digit=F.substring("o_orderpriority", 1, 1),
                      price=F.format_string("%.2f", "o_totalprice"), nothing=F.lit(None).cast("string"))
    return texts.select(
        "o_orderkey",
        parsing.safe_int(F.col("o_orderpriority")).alias("bad_int"), parsing.safe_int(F.col("digit")).alias("good_int"),
        parsing.safe_int(F.col("price")).alias("decimal_int"), parsing.safe_float(F.col("price")).alias("good_float"),
        parsing.safe_float(F.col("o_orderpriority")).alias("bad_float"), parsing.safe_int(F.col("nothing")).alias("null_int"),
    )


@query
def normalize_events(t: Inputs) -> DataFrame:
    return _amounts_as_numbers(ev.normalize_messages(t.messages).drop("seq_ts"))


def _amounts_as_numbers(df: DataFrame) -> DataFrame:
    """Amounts are text in these records; engines write the same number differently."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("fare_amount", "tip_amount", "total_amount")})


@query
def speed_mph_stats(t: Inputs) -> DataFrame:
    return _rounded_std(profiles.speed_mph_stats(t.raw))


def _rounded_std(df: DataFrame) -> DataFrame:
    """Deviations come from floating sums; six digits are the same in any order of rows."""
    return df.withColumn("std", F.round("std", 6))


@query
def payment_labels(t: Inputs) -> DataFrame:
    return profiles.payment_labels(t.raw)


@query
def dow_hour_matrix(t: Inputs) -> DataFrame:
    return profiles.dow_hour_matrix(t.curated, "pickup_ts")


@query
def tip_analysis(t: Inputs) -> DataFrame:
    return profiles.tip_analysis(t.raw)


@query
def payment_mix(t: Inputs) -> DataFrame:
    return reports.payment_mix(t.staged)


@query
def card_share(t: Inputs) -> DataFrame:
    return reports.card_share(t.staged)


@query
def events_json(t: Inputs) -> DataFrame:
    return ev.events_json(ev.trip_events(t.staged))


# -------------------------------------------------------- filters, validation


@query
def dq_filter(t: Inputs) -> DataFrame:
    return quality.dq_filter(t.derived).select("row_offset", PICKUP, quality.DROPOFF, "avg_speed_kmh", "total_amount")


@query
def dq_rejections(t: Inputs) -> DataFrame:
    return quality.dq_rejections(t.derived)


@query
def curation_stats(t: Inputs) -> DataFrame:
    return quality.curation_stats(t.derived)


@query
def curation_summary(t: Inputs) -> DataFrame:
    return quality.curation_summary(t.derived, month(PICKUP))


@query
def validate_trips(t: Inputs) -> DataFrame:
    return t.validated.select("trip_key", "vendor_id", joined("failed_rules").alias("failed_rules"))


@query
def validate_trip_create(t: Inputs) -> DataFrame:
    rows = validation.validate(t.records, validation.create_rules())
    return rows.select("trip_key", joined("failed_rules").alias("failed_rules"))


@query
def validate_trip_update(t: Inputs) -> DataFrame:
    """Uncurated rows, so that negative totals are met."""
    rows = validation.validate(quality.standardize_columns(t.raw), validation.update_rules())
    return rows.select("row_offset", "total_amount", joined("failed_rules").alias("failed_rules"))


@query
def validate_zones(t: Inputs) -> DataFrame:
    rows = validation.validate(t.zones, validation.zone_rules())
    return rows.select("zone_id", "zone_name", joined("failed_rules").alias("failed_rules"))


def _contract(t: Inputs) -> DataFrame:
    """Contract events of all keyed trips; tips of trips paid by type 5 carry an unknown type."""
    nested = ev.contract_events(t.records)
    unknown = (F.col("event_type") == "TIP") & (F.col("payload.tip_amount") == 0)
    return nested.withColumn("event_type", F.when(unknown, "REFUND").otherwise(F.col("event_type")))


@query
def validate_contract_events(t: Inputs) -> DataFrame:
    rows = validation.validate_contract_events(ev.flatten_contract(_contract(t)))
    return rows.groupBy("event_type", joined("failed_rules").alias("failed_rules")).agg(
        F.count("*").alias("events"), F.min("event_ts").alias("first_event"), max_text(F.col("trip_key")).alias("last_key"))


@query
def parse_events(t: Inputs) -> DataFrame:
    return t.parsed.select(
        "seq_id", "event_id", "trip_key", "event_type", "event_ts", "vendor_id", "vehicle_id_h", "source", "pickup_zone_id",
        "passenger_count", "dropoff_zone_id", "trip_distance", "trip_duration_minutes", "fare_amount", "tip_amount",
        "total_amount", "payment_type", "zone_id", "reject_reason",
    )


@query
def verify_curated(t: Inputs) -> DataFrame:
    return quality.verify_curated(t.curated, month("pickup_ts"))


@query
def sanity_check(t: Inputs) -> DataFrame:
    return quality.sanity_check(t.raw)


@query
def dq_issue_counts(t: Inputs) -> DataFrame:
    return quality.dq_issue_counts(t.raw)


@query
def trip_distance_stats(t: Inputs) -> DataFrame:
    return _rounded_std(profiles.trip_distance_stats(t.raw))


@query
def dq_documented_rules(t: Inputs) -> DataFrame:
    """Trips of the event stream, whose zones go beyond the dimension."""
    return quality.documented_rules(t.zones, t.stream_trips)


@query
def kpi_backfill(t: Inputs) -> DataFrame:
    return kpis.kpi_backfill(t.staged, dt.datetime(2025, 1, 3), dt.datetime(2025, 1, 5))


@query
def recent_trips(t: Inputs) -> DataFrame:
    """Share of the trips picked up in the hour before a fixed moment."""
    return staging.recent_share(t.staged, staging.timestamp_literal(dt.datetime(2025, 1, 14, 12)), "pickup_ts")


@query
def trip_lookup(t: Inputs) -> DataFrame:
    """The greatest key, looked up in a stored table."""
    stored = staging_table(f"{_run_folder(t)}/trips", keys_hold_time=True)
    stored.upsert(t.spark, t.staged, "all")
    return stored.lookup(t.spark, stored.read(t.spark).agg(F.max("trip_key")).scalar())


@query
def null_audit(t: Inputs) -> DataFrame:
    return quality.null_audit(t.records, (
        "trip_key", "vendor_id", "pickup_ts", "dropoff_ts", "pu_zone_id", "do_zone_id", "vehicle_id_h",
        "passenger_count", "congestion_surcharge",
    ))


@query
def log_filter(t: Inputs) -> DataFrame:
    return metrics.filter_level(t.logs, "ERROR").select("event_id", "log_time", "level", "message")


@query
def histograms(t: Inputs) -> DataFrame:
    return profiles.histograms(t.curated)


# ---------------------------------------------------------------------- joins


@query
def top_zones(t: Inputs) -> DataFrame:
    return reports.top_zones(t.staged, t.zones)


@query
def top_zones_mart(t: Inputs) -> DataFrame:
    return reports.top_zones_mart(t.kpis, t.zones)


@query
def fk_orphans(t: Inputs) -> DataFrame:
    """Trips of the event stream, whose zones go beyond the dimension."""
    return staging.zone_orphans(t.stream_trips, t.zones)


@query
def fk_orphans_staged(t: Inputs) -> DataFrame:
    return staging.zone_orphans(t.staged, t.zones)


@query
def fk_enforce_staged(t: Inputs) -> DataFrame:
    marked = staging.with_zone_reason(t.staged, t.zones)
    return marked.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("trips"))


@query
def dq_documented_rules_staged(t: Inputs) -> DataFrame:
    return quality.documented_rules(t.zones, t.staged)


@query
def trips_with_zones(t: Inputs) -> DataFrame:
    rows = staging.trips_with_zones(t.staged, t.zones)
    return rows.select("trip_key", "pu_zone_id", "pu_borough", "pu_zone_name", "pu_service_zone",
                       "do_zone_id", "do_borough", "do_zone_name", "do_service_zone")


@query
def fk_enforce(t: Inputs) -> DataFrame:
    marked = staging.with_zone_reason(t.stream_trips, t.zones)
    return marked.select("trip_key", F.coalesce("reject_reason", F.lit("kept")).alias("outcome"))


@query
def reject_ledger(t: Inputs) -> DataFrame:
    """What became of every raw trip: curation, then key, rules and zones of staging. The counts add up to the input."""
    curation = quality.with_reject_reason(t.derived).groupBy("reject_reason").agg(F.count("*").alias("trips"))
    staged = staging.judged_trips(t.curated, t.zones, SALT, "batch", AS_OF).groupBy("reject_reason").agg(F.count("*").alias("trips"))
    rows = curation.where("reject_reason is not null").withColumn("stage", F.lit("curation")).unionByName(staged.withColumn("stage", F.lit("staging")))
    return rows.select("stage", F.coalesce("reject_reason", F.lit("kept")).alias("reason"), "trips")


# --------------------------------------------------------------- aggregations


@query
def zone_hourly_kpis(t: Inputs) -> DataFrame:
    return t.kpis


@query
def kpi_full_refresh(t: Inputs) -> DataFrame:
    """Mart rows of the full refresh with all measures; the mart's decimals as numbers."""
    rows = kpis.mart_rows(kpis.kpi_full_refresh(t.staged), AS_OF)
    return rows.select("zone_id", "hour_ts", "trips", "unique_vehicles", *_as_doubles(MART_MEASURES), "created_at",
                       F.col("outlier_rate").isNull().alias("no_outlier_rate"))


@query
def kpi_incremental(t: Inputs) -> DataFrame:
    return kpis.kpi_incremental(t.staged, dt.datetime(2025, 1, 7, 10, 30), 12)


@query
def kpi_run_stats(t: Inputs) -> DataFrame:
    return kpis.kpi_run_stats(kpis.kpi_incremental(t.staged, dt.datetime(2025, 1, 7, 10, 30), 12))


@query
def kpi_status(t: Inputs) -> DataFrame:
    return kpis.kpi_status(t.kpis)


@query
def trip_report(t: Inputs) -> DataFrame:
    return reports.trip_report(t.staged)


@query
def kpi_report(t: Inputs) -> DataFrame:
    return reports.kpi_report(t.kpis)


@query
def zone_report(t: Inputs) -> DataFrame:
    return reports.zone_report(t.zones)


@query
def revenue_stats(t: Inputs) -> DataFrame:
    return reports.revenue_stats(t.staged)


@query
def reconcile_source(t: Inputs) -> DataFrame:
    return reports.reconcile_source(_upserted_trips(t))


@query
def reconcile_mart(t: Inputs) -> DataFrame:
    return reports.reconcile_mart(t.kpis)


@query
def peak_hours_mart(t: Inputs) -> DataFrame:
    return reports.peak_hours_mart(t.kpis)


@query
def throughput_by_hour(t: Inputs) -> DataFrame:
    return reports.throughput_by_hour(t.staged)


@query
def duplicate_keys(t: Inputs) -> DataFrame:
    return reports.duplicates(t.raw, "row_offset")


@query
def duplicate_sources(t: Inputs) -> DataFrame:
    return reports.duplicates(t.staged, "vendor_id", "pickup_ts", "pu_zone_id")


@query
def trips_by_hour(t: Inputs) -> DataFrame:
    return profiles.trips_by_hour(t.raw, PICKUP)


@query
def trips_by_weekday(t: Inputs) -> DataFrame:
    return profiles.trips_by_weekday(t.raw, PICKUP)


@query
def daily_volume(t: Inputs) -> DataFrame:
    return profiles.daily_volume(t.curated, "pickup_ts").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query
def fare_speed_by_hour(t: Inputs) -> DataFrame:
    return profiles.fare_speed_by_hour(t.curated)


@query
def value_counts(t: Inputs) -> DataFrame:
    return profiles.value_counts(t.curated, ["payment_type", "passenger_count", "pu_zone_id"])


@query
def top_locations(t: Inputs) -> DataFrame:
    return profiles.top_values(t.raw, ["PULocationID", "DOLocationID"])


@query
def quantiles(t: Inputs) -> DataFrame:
    return profiles.exact_quantiles(t.curated, profiles.KEY_METRICS, profiles.QUANTILES)


@query
def fare_stats(t: Inputs) -> DataFrame:
    return _rounded_std(profiles.fare_stats(t.raw))


@query
def passenger_stats(t: Inputs) -> DataFrame:
    return profiles.passenger_stats(t.raw)


NUMERIC = ("passenger_count", "trip_distance", "payment_type", "fare_amount", "tip_amount", "total_amount",
           "distance_km", "duration_min", "avg_speed_kmh")


@query
def describe_numeric(t: Inputs) -> DataFrame:
    return _rounded_std(profiles.describe_numeric(t.curated, NUMERIC))


@query
def null_profile(t: Inputs) -> DataFrame:
    return profiles.null_profile(t.raw.select(*RAW_COLUMNS))


RAW_COLUMNS = ("VendorID", "passenger_count", "trip_distance", "store_and_fwd_flag", "congestion_surcharge",
               "total_amount", "extra")


@query
def overview(t: Inputs) -> DataFrame:
    return profiles.overview(t.curated.select(*CURATED_COLUMNS))


@query
def month_summary(t: Inputs) -> DataFrame:
    return profiles.month_summary(t.curated, month("pickup_ts"))


@query
def event_type_counts(t: Inputs) -> DataFrame:
    return ev.event_type_counts(ev.valid_events(t.parsed).withColumn("service", F.col("source")), "service")


@query
def key_collisions(t: Inputs) -> DataFrame:
    return reports.key_collisions(t.records)


# ----------------------------------------------------------- windows, limits


@query
def missing_events(t: Inputs) -> DataFrame:
    return state.missing_events(t.state).select("trip_key", joined("missing").alias("missing"))


@query
def latest_kpis(t: Inputs) -> DataFrame:
    return kpis.latest_kpis(t.kpis)


@query
def latest_kpi_rows(t: Inputs) -> DataFrame:
    return kpis.latest_kpi_rows(t.kpis)


@query
def latest_trips(t: Inputs) -> DataFrame:
    return staging.latest_trips(_one_per_key(t.staged))


@query
def sample_rows(t: Inputs) -> DataFrame:
    return profiles.sample_rows(t.curated, 20, CURATED_COLUMNS, (
        "pickup_ts", "dropoff_ts", "pu_zone_id", "do_zone_id", "distance_km", "duration_min", "avg_speed_kmh",
        "fare_amount", "total_amount",
    ))


# --------------------------------------------------------------------- events


@query
def trip_events(t: Inputs) -> DataFrame:
    events = ev.trip_events(t.staged)
    return events.select("event_id", "trip_key", "event_type", "timestamp", "vendor_id", "vehicle_id_h",
                         "pickup_zone_id", "passenger_count", "dropoff_zone_id", "trip_distance",
                         "trip_duration_minutes", "fare_amount", "tip_amount", "total_amount", "payment_type",
                         "zone_id")


@query
def event_stats(t: Inputs) -> DataFrame:
    return ev.event_stats(t.validated)


@query
def late_events(t: Inputs) -> DataFrame:
    return ev.late_events(ev.trip_events(t.staged)).select("trip_key", "event_type", "event_ts", "is_late", "arrival_ts")


@query
def flatten_contract(t: Inputs) -> DataFrame:
    flat = ev.flatten_contract(_contract(t))
    return flat.select("trip_key", "event_type", "event_version", "event_ts", "vehicle_id_h", "vendor_id",
                       "pu_zone_id", "do_zone_id", "passenger_count", "fare_amount", "total_amount", "tip_amount",
                       "payment_type", "pickup_ts", "dropoff_ts")


# ---------------------------------------------------------------------- state


@query
def event_state(t: Inputs) -> DataFrame:
    rows = state.event_state(t.events, ARRIVAL_OF_EVENTS)
    return rows.select("trip_key", "event_type", "event_id", "timestamp", "vendor_id", "vehicle_id_h", "pickup_zone_id",
                       "passenger_count", "dropoff_zone_id", "trip_distance", "fare_amount", "tip_amount",
                       "total_amount", "payment_type", "zone_id")


@query
def field_state(t: Inputs) -> DataFrame:
    rows = state.field_state(ev.normalize_messages(t.messages), ARRIVAL)
    return _amounts_as_numbers(rows)


@query
def trip_sessions(t: Inputs) -> DataFrame:
    return state.trip_sessions(t.events)


@query
def complete_trips(t: Inputs) -> DataFrame:
    return state.complete_trips(t.state).select("trip_key", "mask")


@query
def complete_mask(t: Inputs) -> DataFrame:
    return t.state.select("trip_key", "mask", state.is_complete_mask(F.col("mask")).alias("complete"))


@query
def trip_snapshots(t: Inputs) -> DataFrame:
    return state.trip_snapshots(t.state)


@query
def assembled_trips(t: Inputs) -> DataFrame:
    return state.assembled_trips(t.state)


@query
def assembled_trips_full(t: Inputs) -> DataFrame:
    return state.assembled_trips_full(t.state, AS_OF)


@query
def assembled_trips_stream(t: Inputs) -> DataFrame:
    """A streaming run over all messages into a keyed table: parse, keep state, upsert; then the table."""
    run = f"{work_dir(t.spark)}/streams/{uuid.uuid4()}"
    trips = staging_table(f"{run}/trips")
    messages = star.event_messages(star.event_stream(t.spark, t.sf_dir))
    stream = start_assembly(messages, trips, f"{run}/checkpoint", AS_OF)
    stream.awaitTermination()
    return trips.read(t.spark)


@query
def stream_outcomes(t: Inputs) -> DataFrame:
    """A streaming run in which trips that break a rule or name an unknown zone are rejected: what became of each trip."""
    run = f"{work_dir(t.spark)}/streams/{uuid.uuid4()}"
    trips = staging_table(f"{run}/trips")
    start_assembly(star.event_messages(star.event_stream(t.spark, t.sf_dir)), trips, f"{run}/checkpoint", AS_OF, zones=t.zones).awaitTermination()
    kept = trips.read(t.spark).select("trip_key", F.lit("kept").alias("outcome"))
    return kept.unionByName(read_rejects(t.spark, trips).select("trip_key", F.col("reject_reason").alias("outcome")))


@query
def expiring_trips_stream(t: Inputs) -> DataFrame:
    """A streaming run in which a trip's state ends six hours after its last event, and an event after that starts it anew."""
    run = f"{work_dir(t.spark)}/streams/{uuid.uuid4()}"
    trips = staging_table(f"{run}/trips")
    messages = star.event_messages(star.event_stream(t.spark, t.sf_dir))
    start_assembly(messages, trips, f"{run}/checkpoint", AS_OF, clock="event").awaitTermination()
    return trips.read(t.spark)


@query
def deleted_trips_stream(t: Inputs) -> DataFrame:
    """A streaming run with deletions among the messages: a trip is forgotten up to the time of some of its errors."""
    run = f"{work_dir(t.spark)}/streams/{uuid.uuid4()}"
    trips = staging_table(f"{run}/trips")
    events = star.event_stream(t.spark, t.sf_dir)
    messages = star.event_messages(events).select("key", "value")
    cut = star.stream_events(events).where("event_type = 'zone_exited' AND k % 2 = 0").select("trip_key", "seq_ts")
    start_assembly(messages.unionByName(ev.deletion_messages(cut, "seq_ts")), trips, f"{run}/checkpoint", AS_OF).awaitTermination()
    return trips.read(t.spark)


@query
def field_state_stream(t: Inputs) -> DataFrame:
    """A streaming run that keeps the latest value per field, and what it left."""
    run = f"{work_dir(t.spark)}/streams/{uuid.uuid4()}"
    messages = star.event_messages(star.event_stream(t.spark, t.sf_dir))
    start_field_state(messages, f"{run}/fields", f"{run}/checkpoint", ARRIVAL).awaitTermination()
    return _amounts_as_numbers(field_store(messages, f"{run}/fields", ARRIVAL).read(t.spark))


@query
def assembly_round_trip(t: Inputs) -> DataFrame:
    """Trips to events and back: what the assembled trips keep of the staged ones."""
    events = ev.trip_events(_one_per_key(t.staged))
    rows = state.assembled_trips_full(state.trip_state(events), AS_OF, "batch")
    return rows.withColumn("passenger_count", F.nullif("passenger_count", F.lit(0)))


@query
def assembly_stats(t: Inputs) -> DataFrame:
    return state.assembly_stats(t.parsed, ARRIVAL)


@query
def partial_trip_count(t: Inputs) -> DataFrame:
    return state.partial_trip_count(t.state)


@query
def dedup_events(t: Inputs) -> DataFrame:
    """Every event delivered twice, then reduced to one."""
    delivered = t.events.unionByName(t.events)
    return state.dedup_events(delivered).select("event_id", "trip_key", "event_type", "timestamp")


# -------------------------------------------------------------------- metrics


@query
def trip_outcomes(t: Inputs) -> DataFrame:
    return metrics.outcomes(t.validated, "batch")


@query
def dq_failures(t: Inputs) -> DataFrame:
    return validation.failures_by_rule(t.validated)


@query
def latency_histogram(t: Inputs) -> DataFrame:
    rows = metrics.bucket_histogram(t.table("events"), F.col("value"), LATENCY_BUCKETS, "event_type")
    return rows.withColumn("le", F.when(F.col("le") < float("inf"), F.col("le")))


@query
def latency_quantiles(t: Inputs) -> DataFrame:
    return metrics.bucket_quantiles(t.table("events"), F.col("value"), [0.5, 0.9], LATENCY_BUCKETS, "event_type")


@query
def batch_size_histogram(t: Inputs) -> DataFrame:
    """Events per user and hour as batch sizes."""
    batches = t.table("events").groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("size"))
    rows = metrics.bucket_histogram(batches, F.col("size"), BATCH_SIZE_BUCKETS)
    return rows.withColumn("le", F.when(F.col("le") < float("inf"), F.col("le")))


def _arrivals(t: Inputs) -> DataFrame:
    """Events with an arrival time ``value`` seconds after they happened."""
    micros = F.round(F.col("value") * 1e6).cast("bigint")
    return t.table("events").withColumn("ingest_ts", F.timestamp_add("MICROSECOND", micros, F.col("ts")))


@query
def queue_lag(t: Inputs) -> DataFrame:
    return metrics.queue_lag(_arrivals(t), "ts", "ingest_ts")


@query
def revenue_by_zone(t: Inputs) -> DataFrame:
    return metrics.revenue_by_zone(t.staged)


@query
def event_rate_5m(t: Inputs) -> DataFrame:
    return metrics.rates(t.table("events"), "ts", F.when(F.col("event_type") == "purchase", F.col("value")))


ALERT_LIMITS = metrics.AlertLimits(failures_per_second=0.003, error_share=0.003, failure_minutes=3, error_minutes=3)


@query
def alerts(t: Inputs) -> DataFrame:
    """Limits low enough for the sparse event table."""
    lag = metrics.queue_lag(_arrivals(t), "ts", "ingest_ts")
    failures = metrics.failure_rate(t.table("events"), "ts", F.col("event_type") == "error")
    return metrics.alerts(lag, failures, ALERT_LIMITS)


@query
def log_parse(t: Inputs) -> DataFrame:
    return t.logs.select("event_id", "log_time", "level", "component", "message")


@query
def log_volume(t: Inputs) -> DataFrame:
    return metrics.log_volume(t.logs, "ts")


@query
def parse_metric_lines(t: Inputs) -> DataFrame:
    return metrics.parse_metric_lines(star.metric_lines(t.spark, t.sf_dir), "event_id")


@query
def metric_total(t: Inputs) -> DataFrame:
    samples = metrics.parse_metric_lines(star.metric_lines(t.spark, t.sf_dir), "event_id")
    return metrics.metric_total(samples, "trip_events_total")

"""The trip domain expressed on the star-schema tables.

Trips come from order lines with their order, customer and supplier; zones from nations; stream
events from the event table. Joins carry no broadcast hint: the sides grow with the data, so
Catalyst decides by measured size and splits hot keys at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.functions.hashing import iso_text
from meterline.functions.numeric import nan_to_null
from meterline.functions.rows import once
from meterline.schemas import TRIP_EVENT
from meterline.sources.files import with_missing_columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw trip per order line."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_linestatus",
    )
    # orders meet their customers first, so that the lines, by far the most rows, are moved once, by order
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.substring("o_orderpriority", 1, 1).alias("priority"))
    ordered = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    trips = (
        lines
        .join(ordered.drop("o_custkey", "c_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    start_second = F.expr("cast(l_orderkey % 14 * 86400 + l_partkey * 37 % 86400 as int)")
    pickup = F.timestamp_add("SECOND", start_second, F.lit("2025-01-01").cast("timestamp_ntz"))
    fare = F.col("l_extendedprice") / 1000.0
    total = fare * (1.0 + F.col("l_discount") + F.col("l_tax"))
    dropoff = F.timestamp_add("SECOND", F.expr("cast((l_quantity - 2) * 60 as int)"), pickup)
    trips = once(trips, tpep_pickup_datetime=pickup, tpep_dropoff_datetime=dropoff).select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("row_offset"),
        F.col("l_linenumber").alias("VendorID"),
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        F.expr("nullif(l_linenumber, 7)").alias("passenger_count"),
        (F.col("l_extendedprice") / 5000.0).alias("trip_distance"),
        F.expr("cast(l_quantity as int) % 6 + 1").alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("store_and_fwd_flag"),
        (F.col("c_nationkey") + 1).alias("PULocationID"),
        (F.col("s_nationkey") + 1).alias("DOLocationID"),
        F.col("priority").cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        (fare * F.col("l_discount")).alias("tip_amount"),
        (F.col("l_tax") * 10.0).alias("tolls_amount"),
        F.when(F.col("l_orderkey") % 97 == 0, -total).otherwise(total).alias("total_amount"),
        F.expr("nullif(l_tax, 0.0D)").alias("congestion_surcharge"),
        (F.col("l_discount") * 10.0).alias("Airport_fee"),
    )
    return with_missing_columns(nan_to_null(trips))


def zone_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones under the column names of the zone file."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    service = (
        F.when(F.col("r_name") == "AMERICA", "Yellow Zone")
        .when(F.col("r_name") == "EUROPE", "Airports").otherwise("Boro Zone")
    )
    return nations.select(
        (F.col("n_nationkey") + 1).alias("LocationID"), F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"), service.alias("service_zone"),
    )


def _event_number() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def stream_events(events: DataFrame) -> DataFrame:
    """Wide stream events of the event table or stream, with ``seq_ts`` and ``seq_id`` as arrival order.

    A trip is a user's day. Fields belong to the event type that carries them; ``k`` is the event's
    number, from which faults are derived.
    """
    k, kind = F.col("k"), F.col("kind")
    renamed = F.expr("""case event_type when 'click' then 'trip_started' when 'view' then 'trip_ended'
                        when 'purchase' then 'payment_processed' when 'signup' then 'zone_entered'
                        when 'error' then 'zone_exited' else event_type end""")
    events = once(events, k=_event_number(), kind=renamed)
    started, ended, paid = (kind == t for t in ("trip_started", "trip_ended", "payment_processed"))
    moved = kind.isin("zone_entered", "zone_exited")
    fields = {
        "event_id": F.concat(F.lit("evt-"), F.col("event_id").cast("string")),
        "trip_key": F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")),
        "event_type": kind,
        "timestamp": iso_text(F.col("ts")),
        "vendor_id": (F.col("user_id") % 6 + 1).cast("int"),
        "vehicle_id_h": F.concat(F.lit("veh_"), F.lpad((F.col("user_id") % 5000).cast("string"), 12, "0")),
        "source": F.lit("stream"),
        "pickup_zone_id": F.when(started, k + 1),
        "passenger_count": F.when(started & (k % 10 != 9), k % 10),
        "dropoff_zone_id": F.when(ended, k + 1),
        "trip_distance": F.when(ended, F.col("value")),
        "fare_amount": F.when(paid, F.col("value")),
        "tip_amount": F.when(paid & (k % 4 != 0), F.col("value") / 8.0),
        "total_amount": F.when(paid, F.col("value") * 1.25),
        "payment_type": F.when(paid, k % 6 + 1),
        "zone_id": F.when(moved, k + 1),
    }
    columns = [fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TRIP_EVENT.fields]
    return events.select(*columns, F.col("ts").alias("seq_ts"), F.col("event_id").alias("seq_id"), "k")


def event_messages(events: DataFrame) -> DataFrame:
    """JSON messages of the event table or stream, with the faults a real topic has.

    Some have an unknown type, no trip key, a broken time or are no JSON at all.
    """
    broken = stream_events(events).withColumns({
        "event_type": F.when(F.col("k") >= 95, F.lit("driver_break")).otherwise(F.col("event_type")),
        "trip_key": F.when(F.col("k") >= 3, F.col("trip_key")),
        "timestamp": F.when(F.col("k") == 50, F.lit("not-a-time")).when(F.col("k") != 51, F.col("timestamp")),
    })
    text = F.to_json(F.struct(*TRIP_EVENT.names))
    value = F.when(F.col("k") == 60, F.translate(text, "{}", "")).otherwise(text)
    return once(broken, key=F.col("trip_key"), value=value).select("key", "value", "seq_ts", "seq_id")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service log lines, one per event; a few carry no component or no level."""
    k, ts = F.col("k"), F.concat(iso_text(F.col("ts")), F.lit("Z"))
    level = F.expr("""case event_type when 'error' then 'ERROR' when 'signup' then 'WARNING'
                      when 'purchase' then 'DEBUG' else 'INFO' end""")
    component = F.concat(F.lit("assembler-"), (F.col("user_id") % 5).cast("string"))
    message = F.concat(F.lit("processed "), F.col("event_type"), F.lit(" for user "), F.col("user_id").cast("string"))
    line = (
        F.when(k < 5, F.concat_ws(" ", F.lit("stray output:"), message))
        .when(k < 20, F.concat_ws(" ", ts, level, message))
        .otherwise(F.concat_ws(" ", ts, level, F.concat(F.lit("["), component, F.lit("]")), message))
    )
    events = once(table(spark, sf_dir, "events"), k=_event_number())
    return once(events, line=line).select("event_id", "ts", "line")


def metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric exposition lines, one per event, with comments, blanks and bad values between them."""
    k = F.col("k")
    label = F.concat(F.lit('{event_type="'), F.col("event_type"), F.lit('",shard="'),
                     F.col("user_id").cast("string"), F.lit('"}'))
    line = (
        F.when(k < 3, F.lit("# TYPE trip_events_total counter"))
        .when(k < 5, F.lit(""))
        .when(k < 8, F.concat(F.lit("trip_events_total"), label, F.lit(" not-a-number")))
        .when(k % 2 == 0, F.concat(F.lit("trip_events_total"), label, F.lit(" "), k.cast("string")))
        .otherwise(F.concat(F.lit("queue_lag_seconds"), label, F.lit(" "), k.cast("string")))
    )
    events = once(table(spark, sf_dir, "events"), k=_event_number())
    return once(events, line=line).select("event_id", "line")

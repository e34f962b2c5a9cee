"""Times headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from meterline.plans.catalog import QUERIES  # noqa: E402
from meterline.session import build_session  # noqa: E402

HEADLINE = (
    "dq_rejections", "curation_stats", "to_complete_trip", "zone_hourly_kpis", "top_zones", "upsert_trips",
    "upsert_kpis", "trip_report", "quantiles", "histograms", "describe_numeric", "trip_events", "events_json",
    "assembly_round_trip", "assembled_trips", "field_state", "parse_events", "event_rate_5m", "log_parse", "alerts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        # every row and column is computed and none comes to the driver
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("derived_fields")
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    run("assembled_trips_stream")
    streamed = time.perf_counter() - start
    trips = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    result = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rsplit("sf", 1)[-1], "trips": trips,
        "trips_per_minute_to_staging": round(trips / times["to_complete_trip"] * 60),
        "trips_per_minute_to_kpis": round(trips / times["zone_hourly_kpis"] * 60),
        # parse, keep state, upsert; the whole stream, which is not part of the total
        "stream_seconds": round(streamed, 3), "stream_events_per_second": round(events / streamed),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

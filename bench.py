"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS, BENCH_RUNS (default 3).
Each query runs once to warm up, then BENCH_RUNS times; the median counts. Results are forced
with the no-op writer, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from bikenet.registry import load
from bikenet.session import get_spark

# query -> table whose rows it reads, for the rows-per-second figures
HEADLINE = {
    "clean_trips": "lineitem",
    "dedupe_rides": "lineitem",
    "trips_per_station": "lineitem",
    "hourly_pattern": "events",
    "rideable_split": "lineitem",
    "top_stations": "lineitem",
    "rideable_shares": "lineitem",
    "hour_day_pivot": "events",
    "neighborhood_trip_summary": "lineitem",
    "equity_gap_stations": "lineitem",
    "current_station_availability": "events",
    "latest_per_station": "events",
    "place_trip_starts": "lineitem",
    "place_trip_starts_shuffled": "lineitem",
    "accessibility_scores": "lineitem",
    "validate_trips": "lineitem",
    "kpis": "lineitem",
    "layers_round_trip": "events",
    "status_stream": "events",
    "zipped_trips": "events",
    "validate_csv_files": "events",
    "place_in_catchments": "customer",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = get_spark(
        "bikenet-bench", master=f"local[{cpus}]",
        **{
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().QUERIES
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in sorted(set(HEADLINE.values()))}

    def timed(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 4)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {
            n: round(rows[HEADLINE[n]] / s) for n, s in seconds.items() if n in HEADLINE
        },
        "sf": float(scale.group(1)) if scale else sf_dir,
        "master": f"local[{cpus}]",
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS (default 3) set the run.
Each query runs once to warm up; its figure is the median of the runs after that.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verification.catalog import queries  # noqa: E402

HEADLINES = [
    "number_of_interactions", "number_of_interactions_wide", "active_days", "number_of_contacts", "call_duration",
    "percent_nocturnal", "percent_initiated_conversations", "percent_initiated_interactions", "response_delay_text",
    "response_rate_text", "entropy_of_contacts", "balance_of_contacts", "interactions_per_contact", "interevent_time",
    "percent_pareto_interactions", "percent_pareto_durations", "number_of_antennas", "entropy_of_antennas",
    "frequent_antennas", "percent_at_home", "radius_of_gyration", "tag_conversations",
    "subscribers_per_region_per_day", "home_locations", "visitors_per_region_per_day", "region_pairs_per_day",
    "directed_region_pairs_per_day", "transactions_per_hour", "unique_subscribers_per_hour",
    "unique_subscribers_country_per_day", "origin_destination_per_day", "home_region_counts_per_month",
    "enriched_visits",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        # The tables are a few megabytes: keep enough partitions to occupy the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found, times = queries(), {}
    for name in HEADLINES:
        spent = []
        for _ in range(1 + runs):
            started = time.perf_counter()
            found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - started)
        times[name] = round(statistics.median(spent[1:] or spent), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds over the headline queries, median of warm runs",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query after one warm-up; the median is reported), BENCH_QUERIES
(comma-separated names, or "all").
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from hostelry.queries import queries

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "presentation_metrics", "curated_apartments", "curated_details", "user_activity_union",
    "user_activity_with_id", "rental_performance_weekly", "rental_performance_monthly",
    "popular_locations_weekly", "top_listings_weekly", "user_engagement_weekly",
    "user_booking_history", "price_summary", "top_cities_latest", "top5_city_pivot",
    "top_listings_latest", "booking_histogram", "booking_kde", "repeat_vs_onetime",
    "booked_nights", "rolling_repeat", "dq_report", "dq_pk_duplicates", "rows_to_json",
    "pipeline_e2e",
]
ONCE = {"pipeline_e2e"}  # runs the whole chain; one timed run, no warm-up


def timed(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("hostelry-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not chosen else list(registered) if chosen == "all" else chosen.split(",")
    seconds = {}
    for name in names:
        runs = 1 if name in ONCE else RUNS
        if name not in ONCE:
            timed(registered[name], spark)
        seconds[name] = round(
            statistics.median(timed(registered[name], spark) for _ in range(runs)), 3
        )
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS), "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

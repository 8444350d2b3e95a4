"""Time the registered queries and print one JSON line.

BENCH_SF_DIR  folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names (default: the headline queries)
BENCH_RUNS    timed runs per query, the median counts (default 3)

The raw event tables are mapped from the test tables before the clock starts.
The clean tables are then written and timed as build_clean (fixture A) and
build_order_clean (fixture B); views read them as a batch run does. Every
result is written in full to the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

HEADLINE = """
bench_top_artists bench_plays_by_hour bench_user_sessions
clean_events clean_counts json_roundtrip
orders_overview orders_top_songs orders_retention orders_session_stats orders_user_features
overview top_songs top_artists top10_songs top10_artists top_locations plays_by_hour level_stats
page_dist gender_stats level_ratio session_stats session_dist retention active_users_ts
user_features churn_features churn_labels_time churned_users churn_dataset_orders
sql_top_songs merged_songs_by_source merged_top_songs merged_top_artists merged_active_ts
kpi_summary funnel live_feed count_by_artist_key count_by_hour_key count_by_user_key
stream_append stream_window_top_songs user_segments churn_summary_orders
""".split()

SLOW = {"user_segments", "churn_summary_orders", "stream_append", "stream_window_top_songs"}


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from checks import queries as registry
    from checks.compare import session

    spark = session()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    registered = registry.registered()

    def run(name: str) -> None:
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("bench_top_artists")  # start the JVM's compilers before any clock
    registry.raw_path(spark, sf_dir)
    times = {
        "build_clean": timed(lambda: registry.clean_path(spark, sf_dir)),
        "build_order_clean": timed(lambda: registry.order_clean(spark, sf_dir)),
    }
    for name in names:
        repeats = 1 if name in SLOW else runs
        times[name] = statistics.median(timed(lambda: run(name)) for _ in range(repeats))
    spark.stop()
    line = {
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(sec, 3) for name, sec in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()

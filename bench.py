"""Times the headline queries and prints one JSON line.

Every query runs over its whole tables and all its result rows are computed (into a sink that
drops them). BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from rivulet.plans import QUERIES
from rivulet.session import local_session

HEADLINES = [
    "score_10", "classify_class_a", "score_100", "clean_samples", "latest_per_station", "latest_row",
    "locations_feed", "overview_stats", "yearly_trend", "parameter_stats", "most_common_violation",
    "station_year_means", "trend_summary", "top_polluted", "box_stats", "score_histogram",
    "confusion_matrix", "compare_stations", "compare_years", "join_geocode_cache", "join_insights",
    "join_gazetteer_ranked", "enrich_samples", "batch_predict", "forecast_router", "forecast_changepoints", "cache_store",
    "forecast_backtest", "history_forecast_merge", "manifest_first_seen", "extract_samples",
    "chunk_tokens", "knn_topk", "chat_history_window", "suggest_questions",
    "scan_samples_csv", "scan_samples_multi", "rescore_files", "chunk_pages", "error_histogram",
    "join_gazetteer_fuzzy", "knn_index",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, shuffle_partitions=int(cores))
    # The first job pays for starting the session and reading its classes.
    QUERIES["param_means"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

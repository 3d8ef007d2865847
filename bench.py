"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from zonalis.queries import ALL  # noqa: E402
from zonalis.session import build_session  # noqa: E402

HEADLINE = [
    "row_stats", "conform_schema", "drop_exact_duplicates", "daily_summary", "missing_report", "outlier_report",
    "zone_stats", "attach_zone_stats", "group_medians", "hierarchical_impute", "ship_day_medians",
    "lag_features", "ffill_by_group", "rolling_mean", "sequence_windows", "interpolate_series", "split_tail",
    "assign_by_bbox", "knn_haversine_classify", "knn_join", "silhouette", "davies_bouldin",
    "encode_categories", "standard_scale", "select_mutual_info", "regression_metrics", "best_model_table",
    "kmeans_fit_assign", "dbscan", "arma_forecast_by_zone", "seasonal_arma_forecast", "window_regressor", "feature_tables",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    ALL["zone_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the workers and compile once
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

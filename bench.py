"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadpulse.plans import registry  # noqa: E402
from roadpulse.session import build_session  # noqa: E402

HEADLINE = [
    "src_stream_json", "stg_readings", "upsert_merge", "incremental_mart", "join_nearest_weather", "join_scd2_point_in_time",
    "int_enriched", "mart_daily_summary", "mart_congestion", "mart_sensor_performance", "rolling_features", "rolling_range",
    "lag_features", "stream_metrics", "stream_sliding", "volume_anomalies", "sensor_health", "freshness_sensors",
    "quality_metrics", "check_suite", "fill_missing", "iqr_outliers", "prepare_features", "ensemble_predict", "forecast_grid",
    "usage_cost_daily", "topk_volume", "lineage_impact",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cores}]",
        **{"spark.sql.shuffle.partitions": cores, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    cold, warm = {}, {}
    for key in wanted:
        for times in (cold, warm):
            began = time.perf_counter()
            registry.QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm wall time",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

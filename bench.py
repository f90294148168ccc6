"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the number of
timed runs per query, of which the median counts. Results go to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from demandloom.catalog import QUERIES

HEADLINE = (
    "daily_product_rollup",
    "store_day_panel",
    "lag_features",
    "rolling_features",
    "blocked_features",
    "fill_group",
    "fill_panel",
    "ewm_features",
    "target_encoding",
    "all_features",
    "column_profile",
    "duplicate_rows",
    "drift_ks",
    "chronological_split",
    "forecast_metrics",
    "quality_checks",
    "cv_aggregate",
    "multi_horizon",
    "multi_horizon_stores",
    "ensemble_predict",
    "ensemble_dynamic",
    "promotion_decision",
    "demand_cube",
    "staffing_occupancy",
    "staffing_erlang",
    "future_scoring",
    "holt_winters",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    times = {}
    for name in HEADLINE:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

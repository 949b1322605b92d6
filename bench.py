"""Time the headline queries: one warm-up run, then the median of three.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1), runs on local[BENCH_CPUS] and prints
one JSON line. Results go to a sink that discards them, so every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries  # noqa: E402
from wattfold.session import build_session  # noqa: E402

HEADLINE = [
    "decode_readings",
    "ingest_rate",
    "device_slices",
    "household_slices",
    "house_slices",
    "hierarchy_rollup",
    "baselines_device",
    "running_baseline_device",
    "alerts_device",
    "alerts_house",
    "record_breakers",
    "forecast_v0_device",
    "forecast_v0_house",
    "forecast_v1_house",
    "forecast_v2_house",
    "forecast_score",
    "actual_vs_forecast",
    "history_all",
    "query_slices",
    "query_week",
    "alerts_page_device",
    "export_wide",
    "meta_tree",
]


def timed(df_of) -> float:
    started = time.perf_counter()
    df_of().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        "wattfold-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    built = queries.build()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        runs = [timed(lambda: built[name](spark, sf_dir)) for _ in range(4)]
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

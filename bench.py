"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local threads.
Each query is run once to warm up and then timed; the whole result is computed, nothing collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from adlens.session import build_session  # noqa: E402
from catalogue import all_cases  # noqa: E402

HEADLINE = [
    "ctr_device_placement", "ctr_by_hour", "describe_line_items", "top_entities", "quality_checks",
    "hist_ctr", "hist_ctr_lines", "time_since_impression", "group_ctr",
    "target_encode_lines", "encode_all", "hash_features", "feature_table",
    "stratified_sample", "split_train_val_test", "high_corr",
    "evaluate", "roc_curve", "calibration_curve",
    "device_rollup", "model_mae", "hourly_series", "compare_predictions",
    "ab_assign", "ab_report", "ab_mannwhitney", "model_stats", "drift", "metric_history", "stream_model_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cases = all_cases()
    cold, warm = {}, {}
    for name in HEADLINE:
        for times in (cold, warm):
            start = time.perf_counter()
            cases[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": Path(sf_dir).name,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

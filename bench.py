"""Time the main queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads. Each
query runs once to warm up and is then timed over a full run into a sink that drops
its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "earliest_per_bucket",
    "head_stats",
    "head_stats_10m",
    "head_stats_keyed",
    "head_stats_max_level",
    "channel_stats",
    "channel_stats_wide",
    "conditional_stats",
    "representative_last_pair",
    "representative_max_level",
    "merged_states",
    "group_list",
    "topic_lookup",
    "detail_rows",
    "message_rows",
    "decode_json",
    "cell_rows",
    "union_tables_days",
    "upsert_current",
    "upsert_compacted",
    "event_time_exact",
    "event_time_merged",
    "exact_job_water_flow",
    "topic_copy",
    "backfill_rows",
    "job_bridge_1s",
    "job_bridge_10m",
    "job_gas_1s",
    "job_water_1s",
    "job_water_flow",
    "job_bridge_backfill",
    "job_gaswater_backfill",
]


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = round(run(spark, name), 3)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

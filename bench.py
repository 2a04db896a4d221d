"""Time the headline queries and print one JSON line.

Each query is planned and fully run into a noop sink. All run once to warm the session
up, then three times each, of which the median counts. ``BENCH_MODELS=1`` adds the model
fits (one run each).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from weekloom.plans.queries import QUERIES

HEADLINE = [
    "weekly_features",
    "weekly_rollup",
    "entity_day_panel",
    "entity_profile",
    "profile_from_daily",
    "segment_summary",
    "data_quality",
    "median_value",
    "train_threshold",
    "persistence_metrics",
    "score_auc",
    "threshold_sweep",
    "rule_comparison",
    "weekly_features_recent",
    "segment_one_hot",
    "unit_std_features",
    "tier_summary",
    "cluster_quality",
    "expected_level",
    "table_roundtrip",
]
MODELS = ["kmeans_sweep", "cluster_compare", "feature_importance", "model_comparison"]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weekloom-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # shuffles are a few MB here, but each row opens into many: keep every core busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
    for name in HEADLINE:
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(3)), 3)
    if os.environ.get("BENCH_MODELS"):
        times.update({name: round(run(spark, name, sf_dir), 3) for name in MODELS})
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries (median of 3 warm runs each)",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

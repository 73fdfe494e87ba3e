"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is built and run to completion (all result columns are computed, nothing is collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from relfold.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "rollup_spec", "rollup_windows_days", "rollup_windows_months", "rollup_two_level", "two_hop_rollup", "agg_median", "agg_first_last", "agg_nunique", "pivot_stats",
    "last_status_pivot", "lag_diff_rollup", "nth_from_last", "group_rank", "group_zscore", "interval_occupancy", "occupancy_peak", "horizon_trend", "target_encode",
    "pair_affinity", "auc_score", "stratified_folds", "term_counts", "block_entity_attributes", "block_credits", "block_snapshots", "block_applications", "block_cards",
    "block_instalments", "feature_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("relfold-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional) a
comma-separated choice of queries. Each query runs once after one warm-up query, and its rows
go to Spark's no-op sink, so that every column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from riskstream.plans.registry import QUERIES
from riskstream.session import build_session

HEADLINE = (
    "features_all", "feat_category_risk", "to_json_records", "alert_stats", "alert_stats_maps",
    "top_states", "recent_alerts", "amount_histogram", "batch_progress", "dedup_transactions",
    "alert_upsert", "quarantine_bad", "csv_to_parquet", "archive_scan", "archive_stream",
    "alert_stream", "auc_roc", "threshold_sweep", "split_train_test", "train_dt",
    "train_rf_small", "train_gbt", "score_batch",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session("bench", master=f"local[{cores}]", extra={
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("dataset_profile")
    times = {name: run(name) for name in chosen}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()

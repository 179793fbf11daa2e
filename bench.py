"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from cohortflow.registry.catalog import QUERIES
from cohortflow.session import build_session

HEADLINE = (
    "gold_trial_safety_summary",
    "gold_patient_outcomes",
    "gold_drug_efficacy",
    "silver_adverse_events",
    "quality_report",
    "latest_per_group",
    "join_composite_left",
    "rate_by_category",
    "describe_numeric",
    "correlation_matrix",
    "histogram_by_class",
    "leakage_screen",
    "risk_score",
    "snapshot_diff",
    "ingest_json_stream",
    "layout_by_key",
    "ordinal_encode",
    "stratified_split",
    "roc_auc",
    "average_precision",
    "classification_report",
    "q_orr_by_drug_arm",
    "q_complete_by_region",
    "join_outcomes_efficacy",
    "train_gbt",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.files.maxPartitionBytes": "4m",  # the tables are single small files
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's compilers and the Parquet readers before the clock
    spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count().collect()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

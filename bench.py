"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1). BENCH_CPUS: local
cores (default 8). Each query runs twice and the faster run counts, so that JVM
warm-up is left out; a run covers building the plan and computing every row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulseledger.catalogue.queries import QUERIES  # noqa: E402
from pulseledger.session import scratch  # noqa: E402

HEADLINE = (
    "code_99202",
    "code_99453_glucose",
    "code_99453_bp",
    "code_99454_glucose",
    "code_99454_bp",
    "code_99454_combined",
    "code_99457",
    "code_99458",
    "billing_fold",
    "billing_report",
    "coach_queue",
    "patient_overview",
    "patient_search_all",
    "study_extract",
    "study_extract_shared_devices",
    "clean_patients",
    "clean_notes",
    "note_texts",
    "resolve_readings",
    "rejects",
    "load_and_bill",
)


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    with scratch(spark):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        run(shared)


def run(shared: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {
        name: round(min(seconds(spark, sf_dir, name) for _ in range(2)), 3) for name in HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores, BENCH_RUNS the
number of timed runs after one warm-up; the median run counts.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.queries import REGISTRY  # noqa: E402

HEADLINE = [
    "total_count",
    "categorical_counts_long",
    "categorical_counts_wide",
    "numeric_sum",
    "numeric_median",
    "numeric_median_few_groups",
    "joined_aggregates",
    "quantile_edges",
    "quantile_bins",
    "cells_per_bin",
    "process_list",
    "process_regex",
    "process_multiscale",
    "dictionary_categorical",
    "registry_run",
    "survey_run",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mapstrata-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mapstrata-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    logging.disable(logging.WARNING)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    seconds = {}
    for name in chosen:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()

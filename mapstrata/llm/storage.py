"""Written intermediates."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of results that nothing refers to any more. Spark drops
    them when the driver collects garbage, which a driver that only plans seldom does by itself; between two large
    steps of one operator this halves the disk that executors need."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

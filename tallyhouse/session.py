"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it turns a shuffled join into a broadcast one once the
# *measured* size of a side is under the threshold, splits skewed join partitions, and coalesces
# small ones.  Timestamps without a zone are compared in UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster brings its own session."""
    partitions = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyhouse")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        # the call site of every column expression is not recorded: a third of planning time
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

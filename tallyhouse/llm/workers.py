"""Lets Python workers import this package, and bounds the batches they get."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of an Arrow batch of whole texts, where the session has Spark's own default of 64 MB.
BATCH_SETTING, BATCH_BYTES, SPARKS_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20, 64 << 20


def find_package(spark: SparkSession) -> None:
    """Puts the package's folder on the workers' path, for sessions started elsewhere, and makes Arrow batches smaller.

    A cluster whose machines do not share that folder gets the package as any other one: installed, or with ``--py-files``.
    A batch lies in the executor and in the worker at once, for every core; a size that the session chose itself stays.
    """
    if spark.conf.get(BATCH_SETTING).rstrip("b") == str(SPARKS_BATCH_BYTES):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])

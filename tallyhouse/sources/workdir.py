"""The shared folder for checkpoints and for tables written between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Rows of a shuffle that one task may hold, and the bytes of a file or of a shuffle that a task reads.
ROWS_PER_TASK = 500_000
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}
PARTITIONS_SETTING = "spark.sql.shuffle.partitions"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, may fall back to a
    temporary folder; a cluster without the setting is refused, since executors could not read
    one another's files.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created."""
    return f"{shared_folder(spark)}/tallyhouse/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes folders that a job wrote for itself under the shared folder and has read."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settle(frame: DataFrame, label: str) -> DataFrame:
    """Writes a frame to a parquet table in the shared folder and reads it back.  Eager.

    For a frame that several later branches read: it is computed once, its lineage is cut, and a
    lost executor costs a re-read instead of a recomputation.
    """
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def task_count(spark: SparkSession, rows: int, each: int = ROWS_PER_TASK) -> int:
    """Partitions for so many rows: one per ``each``, and one per core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


@contextmanager
def tasks_for(spark: SparkSession, rows: int, each: int = ROWS_PER_TASK) -> Iterator[None]:
    """What is written inside is cut into tasks by its size, so the memory of a task does not grow with the table.

    A session's number of shuffle partitions is fixed, so the hash maps and sorts of a task grow with the input.  Inside,
    the largest shuffle, of ``rows``, has a partition per ``each``, and files are read in small splits, for the map-side
    sums; adaptive execution merges the small partitions of other shuffles.  The session's own settings return behind it, so
    only eager work (``settle``, ``replace_table``) feels it.  A table that one task may hold is left to them.
    """
    if rows <= each:
        yield
        return
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = {name: spark.conf.get(name) for name in (PARTITIONS_SETTING, *TASK_BYTES)}
    spark.conf.set(PARTITIONS_SETTING, str(max(int(before[PARTITIONS_SETTING]), task_count(spark, rows, each))))
    for name, most in TASK_BYTES.items():
        spark.conf.set(name, str(min(most, to_bytes(before[name]))))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when its query ends.

    Otherwise they stay until the driver happens to collect its garbage, so the disk holds the shuffles of all steps at once.
    Only for eager work that is not read again by its plan (``settle``, ``replace_table``).
    """
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)

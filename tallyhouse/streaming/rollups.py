"""R5-R7 as native streaming aggregates with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.functions import aggregate
from tallyhouse.operators.history import totals_by_channel
from tallyhouse.streaming.versions import VersionedTable

LATENESS = "10 minutes"


def minute_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Orders per tumbling minute, emitted whenever a minute changes.

    Events later than the watermark are dropped.  State holds the open minutes only.
    """
    counted = events.withWatermark("timestamp", lateness).groupBy(F.window("timestamp", "1 minute"))
    return counted.agg(F.count("*").alias("count")).selectExpr("window.start as minute", "count")


def channel_totals(events: DataFrame) -> DataFrame:
    """Running totals per channel since the stream began; state is one row per channel."""
    return totals_by_channel(events)


def write_changes(counts: DataFrame, folder: str, name: str, **trigger) -> StreamingQuery:
    """Keeps every change of a keyed aggregate under its batch; a repeated batch replaces its own folder."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/checkpoint-{name}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_minutes(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The newest count of every minute, open minutes included."""
    changes = spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}/batch=*")
    return aggregate(changes, ["minute"], "max_by(count, batch) as count")


def write_latest(totals: DataFrame, folder: str, name: str) -> StreamingQuery:
    """Keeps the complete result of an unwindowed aggregate as a versioned table, a version per batch."""
    table = latest_table(totals.sparkSession, folder, name)
    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(table.write)
        .option("checkpointLocation", f"{folder}/checkpoint-{name}")
        .trigger(availableNow=True)
        .start()
    )


def latest_table(spark: SparkSession, folder: str, name: str) -> VersionedTable:
    """The table that ``write_latest`` keeps."""
    return VersionedTable(spark, f"{folder}/{name}")

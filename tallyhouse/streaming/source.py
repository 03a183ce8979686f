"""The event stream, its contract, and streams run to completion."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.history import rejected_events, valid_events
from tallyhouse.schemas import EVENT_SCHEMA


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def let_workers_import(spark: SparkSession) -> None:
    """Puts the package's folder on the path of Python workers, for sessions started elsewhere.

    A cluster whose machines do not share that folder gets the package as any other one: installed, or with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


def event_stream(
    spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, file_format: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a folder as a stream of events under a declared schema."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def write_table(stream: DataFrame, folder: str, name: str) -> StreamingQuery:
    """Appends a stream to a parquet table, exactly once, with its checkpoint beside it."""
    return (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/{name}")
        .option("checkpointLocation", f"{folder}/checkpoint-{name}")
        .trigger(availableNow=True)
        .start()
    )


def split_by_contract(stream: DataFrame, folder: str) -> list[StreamingQuery]:
    """Valid events to one table, rejected ones with their faults to another."""
    return [
        write_table(valid_events(stream), folder, "valid"),
        write_table(rejected_events(stream), folder, "rejected"),
    ]


def finish(*queries: StreamingQuery) -> None:
    """Waits for streams that stop by themselves; a failure is raised here."""
    for query in queries:
        query.awaitTermination()

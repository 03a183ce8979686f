"""CSV files to raw tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.functions import aggregate, row_hash
from tallyhouse.schemas import RAW_SCHEMAS
from tallyhouse.sources.tables import replace_table

METADATA = ("record_hash", "loaded_at", "source_file", "batch_id")


def _schema(table: str) -> StructType:
    return StructType.fromDDL(RAW_SCHEMAS[table])


def scan_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV file or folder under a declared schema; a row that does not fit fails the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def scan_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read as text, trim, blank to NULL, then type; a cell that does not convert is NULL.

    ``quality.check_field_bounds`` reports required cells that came out NULL.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema])
    rows = spark.read.schema(text).option("header", True).csv(path)
    return rows.selectExpr(
        *[f"try_cast(nullif(trim({f.name}), '') as {f.dataType.simpleString()}) as {f.name}" for f in schema]
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def missing_sources(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """The paths that do not exist, on whatever file system they name."""
    return [path for path in paths.values() if not _exists(spark, path)]


def source_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """A row per source with its path, whether it is missing, and the rows of one that is there."""
    missing = set(missing_sources(spark, paths))
    rows = None
    for table, path in paths.items():
        counted = spark.range(1).selectExpr("cast(null as bigint) as row_count")
        if path not in missing:
            counted = aggregate(scan_csv(spark, path, _schema(table)), [], "count(*) as row_count")
        row = counted.select(F.lit(table).alias("table_name"), F.lit(path).alias("path"), F.lit(path in missing).alias("is_missing"), "row_count")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def with_load_metadata(rows: DataFrame, batch_id: str, loaded_at: datetime, source_file: Column | None = None) -> DataFrame:
    """Content hash of the original columns, load time, source file name and batch."""
    file_name = source_file if source_file is not None else F.element_at(F.split("_metadata.file_path", "/"), -1)
    return rows.select(
        "*",
        F.expr(row_hash(rows.columns)).alias("record_hash"),
        F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
        file_name.alias("source_file"),
        F.lit(batch_id).alias("batch_id"),
    )


def load_raw_tables(
    spark: SparkSession, paths: dict[str, str], folder: str, loaded: Callable[[str], None] | None = None
) -> dict[str, int]:
    """Loads every named CSV into a raw table under ``folder``; returns rows per table.

    All sources are checked first: if any is missing nothing is written and the error lists them
    all.  Every table of a run shares one batch id and load time.  ``loaded`` is called with a
    table's name once it is written, for a caller that has no use for its source from then on.
    """
    missing = missing_sources(spark, paths)
    if missing:
        raise FileNotFoundError("Missing source files:\n" + "\n".join(missing))
    batch_id, now = str(uuid.uuid4()), datetime.now(UTC)
    counts = {}
    for table, path in paths.items():
        source_file = F.lit(path.rstrip("/").rsplit("/", 1)[-1])
        rows = with_load_metadata(scan_csv(spark, path, _schema(table)), batch_id, now, source_file)
        counts[table] = replace_table(rows, f"{folder}/{table}")
        if loaded:
            loaded(table)
    return counts


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What a later batch of a raw table changed, by ``record_hash``: one row per key that differs.

    Of the rows a key had and has, equal hashes cancel out.  Of the rest, as many as stand on both sides are changed, the
    others inserted or gone; repeated rows and null keys count like any.  Counts are summed per task before the one
    shuffle of keys and hashes, so a key with many rows costs a row per hash.
    """
    sides = before.selectExpr(*keys, "record_hash", "-1L as _side").unionByName(
        after.selectExpr(*keys, "record_hash", "1L as _side")
    )
    left_over = aggregate(sides, [*keys, "record_hash"], "sum(_side) as _side").where("_side <> 0")
    counts = aggregate(left_over, keys, "sum(greatest(_side, 0)) as _new", "sum(greatest(-_side, 0)) as _old")
    return counts.selectExpr(
        *keys,
        "_new - least(_new, _old) as inserted_rows",
        "least(_new, _old) as changed_rows",
        "_old - least(_new, _old) as gone_rows",
    )


def load_seeds(spark: SparkSession, folder: str, tables: tuple[str, ...]) -> dict[str, DataFrame]:
    """The hand-kept seed tables of a folder, by name."""
    return {t: scan_seed(spark, f"{folder}/{t}.csv", _schema(t)) for t in tables}

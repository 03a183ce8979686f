"""S5, S12 and plain table reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.functions import aggregate
from tallyhouse.operators.keys import attach
from tallyhouse.sources.workdir import ROWS_PER_TASK, settle, task_count


def laid_out(rows: DataFrame, date: str, row_id: str, each: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt to tasks by date and sorted by date and row id; about ``each`` rows a task, whatever the dates hold.

    Rows are counted per date first (eager), which reads the date alone, where cutting ranges of both columns would make
    every row of the table twice, once to draw a sample of it.  A date starts in the task that the rows before it fill and
    is spread by id over as many as it fills itself, so a task gets at most its own share, a date's share and a date.
    """
    spark = rows.sparkSession
    counted = settle(aggregate(rows, [date], "count(*) as _rows"), "rows-per-date")
    total = counted.agg(F.sum("_rows")).first()[0] or 0
    each = max(1, -(-total // task_count(spark, total, each)))
    count = max(1, -(-total // each))
    ahead = f"(sum(_rows) over (order by {date} rows unbounded preceding) - _rows)"  # a row per date: bounded by the calendar
    slots = counted.selectExpr(date, f"int({ahead} div {each}) as _first", f"(_rows + {each - 1}) div {each} as _n")
    dealt = attach(rows, slots, [date]).withColumn("_slot", F.expr(f"int(least(_first + pmod(xxhash64({row_id}), _n), {count - 1}))"))
    return dealt.repartitionById(count, F.col("_slot")).sortWithinPartitions(date, row_id).select(*rows.columns)


def replace_table(rows: DataFrame, path: str, layout: Sequence[str] = ()) -> int:
    """Creates or replaces a parquet table; returns its row count.

    ``layout`` names a date column and a row id.  The rows are dealt to tasks by date and sorted
    by both, so each file holds a narrow span of dates and a date filter skips files by their
    footers, while a date that holds much of the table is still split over tasks by the id.  The
    count comes from the written footers.  Row hashes and ids are most of a table and hold few
    bits a character, so files are written with zstd, which codes characters by their entropy.
    """
    if layout:
        rows = laid_out(rows, *layout)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).count()


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A written table under its known schema; no footer is read to infer one."""
    return spark.read.schema(schema).parquet(path)


def freshness(tables: dict[str, DataFrame], column: str = "loaded_at") -> DataFrame:
    """Time of the latest load per table."""
    merged = None
    for name, rows in tables.items():
        line = rows.agg(F.lit(name).alias("table_name"), F.max(column).alias("latest_loaded_at"))
        merged = line if merged is None else merged.unionByName(line)
    return merged

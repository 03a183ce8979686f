"""Join helper for frames that were grouped from one another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, grouped: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Adds the columns of a per-key frame to rows, matching NULL keys to the NULL group.

    ``groupBy`` and window partitions treat NULL as a group of its own; an ordinary equi-join
    would lose those rows.  The null-safe comparison is still an equi-join to Spark, so it may be
    broadcast, shuffled or split for skew like any other.
    """
    renamed = grouped.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.expr(" and ".join(f"{k} <=> _{k}" for k in keys))
    return rows.join(renamed, same, how).drop(*[f"_{k}" for k in keys])

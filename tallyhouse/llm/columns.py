"""Names for helper columns that a table does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(frame: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the table has it, in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name

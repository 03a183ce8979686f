"""Which rows a model may learn from, by the checksum of the document's id as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_fold(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id's decimal text falls in one of ``parts`` folds; a null id falls in none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))

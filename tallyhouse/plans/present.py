"""One result shape for every registered query, so results compare across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _shape(field: T.StructField) -> str:
    name, kind = f"`{field.name}`", field.dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return f"cast({name} as bigint) as {name}"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return f"floor({name} * 1000000.0D + 0.5D) / 1000000.0D as {name}"
    if isinstance(kind, T.DecimalType):
        return f"cast({name} as decimal(38,{kind.scale})) as {name}"
    if isinstance(kind, T.TimestampType):
        return f"cast({name} as timestamp_ntz) as {name}"
    if isinstance(kind, T.MapType):
        return f"{map_text(name)} as {name}"
    return name


def map_text(name: str) -> str:
    """A map of counts as ``key=value`` pairs in key order."""
    return f"array_join(transform(array_sort(map_entries({name})), e -> concat(e.key, '=', e.value)), ',')"


def present(rows: DataFrame) -> DataFrame:
    """Whole numbers as bigint, decimals at full width, doubles to six digits, maps as text.

    Doubles are rounded by multiply, floor and divide, which every engine computes alike;
    library ``round`` functions disagree about values halfway between two results.
    """
    return rows.selectExpr(*[_shape(f) for f in rows.schema])

"""The static channel table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.schemas import CHANNEL_REFERENCE


def channel_reference(spark: SparkSession) -> DataFrame:
    """Four fixed rows, as an inline table so that no Python worker starts."""
    rows = ", ".join(
        f"('{channel}', '{label}', {str(delivery).lower()}, {rate}D)" for channel, label, delivery, rate in CHANNEL_REFERENCE
    )
    return spark.sql(
        f"select * from values {rows} as c(channel, channel_label, is_delivery_channel, commission_rate)"
    )

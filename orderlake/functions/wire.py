"""The canonical message of an event: key and JSON value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.times import iso_utc


def event_json() -> Column:
    """Compact JSON of the nine event columns; the amount travels as text."""
    return F.to_json(
        F.struct(
            "event_id",
            "event_type",
            "event_version",
            "order_id",
            "customer_id",
            "order_status",
            F.col("order_amount").cast("string").alias("order_amount"),
            "currency",
            iso_utc(F.col("event_time")).alias("event_time"),
        )
    )


def to_messages(events: DataFrame) -> DataFrame:
    """(key, value) of each event, keyed by order so one order stays in order."""
    return events.select(F.col("order_id").alias("key"), event_json().alias("value"))

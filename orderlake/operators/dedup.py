"""Keep one row per key, without handing a hot key to a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order (batch only).

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle as well: each map task sends at most one row per key, however many
    copies of a key the data holds.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def dedup_events(events: DataFrame, delay: str) -> DataFrame:
    """One row per event_id.

    Stream: duplicates are dropped while the first copy's state lives, that is
    until the watermark passes its event time plus ``delay``; a copy that comes
    later still may be emitted again. Batch: one row per event_id over the whole
    input, the earliest delivered one.
    """
    if events.isStreaming:
        return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
            ["event_id"]
        )
    delivered = ["kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset"]
    return keep_first(events, ["event_id"], [F.col(name).asc() for name in delivered])

"""Bronze: every message is kept, parsed as far as it goes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.once import compute_once
from orderlake.schemas import BRONZE, EVENT, EVENT_COLUMNS, POSITION_COLUMNS


def envelope(messages: DataFrame) -> DataFrame:
    """Key and value as text, with the transport position under its own names."""
    return messages.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_event"),
        *[F.col(name.removeprefix("kafka_")).alias(name) for name in POSITION_COLUMNS],
    )


def parse_payload(enveloped: DataFrame) -> DataFrame:
    """Add the nine event fields and is_valid_json.

    The flag is a test of its own: JSON text may be well formed and still give
    null fields, and lenient field parsing reads text that is not JSON.
    """
    parsed = compute_once(
        enveloped,
        _event=F.from_json("raw_event", EVENT),
        is_valid_json=F.try_parse_json("raw_event").isNotNull(),
    )
    return parsed.select(
        *enveloped.columns,
        *[F.col("_event")[name].alias(name) for name in EVENT_COLUMNS],
        "is_valid_json",
    )


def to_bronze(messages: DataFrame) -> DataFrame:
    """Transport messages to bronze rows, in batch or as a stream."""
    stamped = parse_payload(envelope(messages)).withColumn(
        "ingested_at", F.current_timestamp()
    )
    return stamped.withColumn("ingestion_date", F.to_date("ingested_at")).select(
        BRONZE.fieldNames()
    )

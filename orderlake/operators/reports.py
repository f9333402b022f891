"""Inspection queries over the datasets of the lake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators.quality import repeated_keys

# The columns that each inspection shows, in order.
LATEST_EVENT = "event_id event_type order_status order_amount currency event_time event_date".split()
RECENT_METRICS = (
    "window_start currency created_order_count completed_order_count revenue average_order_value"
).split()
STORED_EVENT = "event_id event_type order_status order_amount event_time".split()
BRONZE_PREVIEW = (
    "event_id event_type order_status order_amount kafka_partition kafka_offset is_valid_json"
).split()
QUARANTINE_PREVIEW = (
    "validation_errors raw_event kafka_partition kafka_offset validated_at"
).split()


def latest_events(silver: DataFrame, n: int = 20) -> DataFrame:
    """The newest events by event time."""
    return (
        silver.select(LATEST_EVENT)
        .orderBy(F.col("event_time").desc(), "event_id")
        .limit(n)
    )


def latest_metrics(gold_metrics: DataFrame, n: int = 20) -> DataFrame:
    """The newest windows of the gold metrics."""
    return gold_metrics.orderBy(F.col("window_start").desc(), "currency").limit(n)


def latest_status(gold_status: DataFrame, n: int = 20) -> DataFrame:
    """The newest windows of the gold status distribution."""
    return gold_status.orderBy(
        F.col("window_start").desc(), "order_status", "currency"
    ).limit(n)


def recent_metrics(metrics_table: DataFrame, n: int = 10) -> DataFrame:
    """The newest windows of the reporting table."""
    return (
        metrics_table.select(RECENT_METRICS)
        .orderBy(F.col("window_start").desc(), "currency")
        .limit(n)
    )


def recent_store_events(store: DataFrame, n: int = 10) -> DataFrame:
    """The events stored last."""
    return (
        store.orderBy(F.col("ingested_at").desc(), "event_id")
        .limit(n)
        .select(STORED_EVENT)
    )


def preview_bronze(bronze: DataFrame, n: int = 20) -> DataFrame:
    """First bronze rows by transport position."""
    return (
        bronze.orderBy("kafka_partition", "kafka_offset")
        .limit(n)
        .select(BRONZE_PREVIEW)
    )


def preview_quarantine(quarantine: DataFrame, n: int = 20) -> DataFrame:
    """First quarantined rows by transport position."""
    return (
        quarantine.orderBy("kafka_partition", "kafka_offset")
        .limit(n)
        .select(QUARANTINE_PREVIEW)
    )


def duplicate_key_count(df: DataFrame, *keys: str) -> DataFrame:
    """How many key values occur more than once (one row)."""
    return repeated_keys(df, [*keys]).agg(F.count("*").alias("duplicate_count"))


def stored_count(store: DataFrame, event_id: str) -> DataFrame:
    """How often one event is stored (one row)."""
    return store.filter(F.col("event_id") == event_id).agg(
        F.count("*").alias("stored_count")
    )


def grain_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Row count beside the number of distinct keys (one row)."""
    return df.agg(
        F.count("*").alias("row_count"), F.count_distinct(*keys).alias("unique_grains")
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named dataset with its number of rows."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)

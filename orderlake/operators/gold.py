"""Gold: tumbling event-time windows per currency.

All aggregates here combine before the shuffle, so a currency that makes up most
of the stream costs one small row per window and map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.schemas import AVERAGE_VALUE, REVENUE


def order_metrics(
    silver: DataFrame, delay: str = "1 day", window: str = "1 hour"
) -> DataFrame:
    """Event counts, revenue and average value of completed orders.

    Revenue is zero and the average null where nothing was completed.
    """
    completed = F.col("event_type") == "order_completed"
    amount = F.when(completed, F.col("order_amount"))
    return _date_and_clock(
        _per_window(
            silver,
            delay,
            window,
            ["currency"],
            F.count("*").alias("order_event_count"),
            F.count_if(F.col("event_type") == "order_created").alias("created_order_count"),
            F.count_if(completed).alias("completed_order_count"),
            _or_zero(F.sum(amount)).alias("revenue"),
            F.avg(amount).alias("average_order_value"),
        )
    )


def status_distribution(
    silver: DataFrame, delay: str = "1 day", window: str = "1 hour"
) -> DataFrame:
    """Event count per order status."""
    return _date_and_clock(
        _per_window(
            silver,
            delay,
            window,
            ["currency", "order_status"],
            F.count("*").alias("status_event_count"),
        )
    )


def hourly_facts(
    silver: DataFrame, window: str = "1 hour", delay: str | None = None
) -> DataFrame:
    """The common grain under both aggregates; a stream needs its ``delay``.

    Scanning silver once for this and rolling it up twice replaces two scans of
    the largest table by one.
    """
    return _per_window(
        silver,
        delay,
        window,
        ["currency", "order_status", "event_type"],
        F.count("*").alias("events"),
        F.sum("order_amount").alias("amount"),
    )


def metrics_from_facts(facts: DataFrame) -> DataFrame:
    """:func:`order_metrics`, rolled up from :func:`hourly_facts`."""

    def events_of(event_type: str) -> Column:
        counted = F.when(F.col("event_type") == event_type, F.col("events"))
        return F.coalesce(F.sum(counted), F.lit(0).cast("bigint"))

    amount = F.sum(F.when(F.col("event_type") == "order_completed", F.col("amount")))
    completed = events_of("order_completed")
    rolled = facts.groupBy("window_start", "window_end", "currency").agg(
        F.sum("events").alias("order_event_count"),
        events_of("order_created").alias("created_order_count"),
        completed.alias("completed_order_count"),
        _or_zero(amount).cast(REVENUE).alias("revenue"),
        # 18 decimals before rounding to 6: exact for up to 10^11 orders a group.
        F.try_divide(amount.cast(REVENUE), completed.cast("decimal(20,0)"))
        .cast(AVERAGE_VALUE)
        .alias("average_order_value"),
    )
    return _date_and_clock(rolled)


def status_from_facts(facts: DataFrame) -> DataFrame:
    """:func:`status_distribution`, rolled up from :func:`hourly_facts`."""
    grain = ["window_start", "window_end", "currency", "order_status"]
    return _date_and_clock(
        facts.groupBy(*grain).agg(F.sum("events").alias("status_event_count"))
    )


def _per_window(
    silver: DataFrame, delay: str | None, window: str, keys: list[str], *measures: Column
) -> DataFrame:
    """window_start, window_end, keys and measures of each tumbling window.

    A stream has to group by the whole window for its watermark to close it. In
    batch the start alone is the smaller key, and the end is the same in a group.
    """
    span = F.window("event_time", window)
    if silver.isStreaming:
        grouped = silver.withWatermark("event_time", delay).groupBy(span.alias("_w"), *keys)
        return grouped.agg(*measures).select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "*",
        ).drop("_w")
    return silver.groupBy(span.start.alias("window_start"), *keys).agg(
        F.min(span.end).alias("window_end"), *measures
    )


def _date_and_clock(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "window_date": F.to_date("window_start"),
            "aggregated_at": F.current_timestamp(),
        }
    )


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast("decimal(20,2)"))

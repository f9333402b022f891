"""Reporting: staging projections, status pivot and the hourly mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.contract import ORDER_STATUSES
from orderlake.schemas import METRICS_TABLE, STATUS_TABLE

#: Mart column that counts the events of each status.
STATUS_COUNT_COLUMN = {
    status: (
        "completed_status_event_count"
        if status == "completed"  # completed_order_count counts by event type
        else f"{status}_event_count"
    )
    for status in ORDER_STATUSES
}
MART_KEY = ["window_start", "currency"]


def stage_metrics(metrics_table: DataFrame) -> DataFrame:
    return metrics_table.select(METRICS_TABLE.fieldNames())


def stage_status(status_table: DataFrame) -> DataFrame:
    return status_table.select(STATUS_TABLE.fieldNames())


def pivot_status(staged_status: DataFrame) -> DataFrame:
    """One row per window and currency with a count column per status.

    A status that does not occur in a window stays null here.
    """
    return staged_status.groupBy(*MART_KEY).agg(
        *[
            F.sum(
                F.when(F.col("order_status") == status, F.col("status_event_count"))
            ).alias(column)
            for status, column in STATUS_COUNT_COLUMN.items()
        ]
    )


def hourly_mart(staged_metrics: DataFrame, staged_status: DataFrame) -> DataFrame:
    """Metrics of each window and currency with its status counts, 0 if none.

    Both sides are unique on the join key and no larger than windows times
    currencies, so the join strategy is left to Spark's own size estimates.
    """
    counts = [
        F.coalesce(F.col(column), F.lit(0).cast("bigint")).alias(column)
        for column in STATUS_COUNT_COLUMN.values()
    ]
    measures = [c for c in METRICS_TABLE.fieldNames() if c not in ("aggregated_at", "loaded_at")]
    return staged_metrics.join(pivot_status(staged_status), MART_KEY, "left").select(
        *measures, *counts, "aggregated_at", "loaded_at"
    )

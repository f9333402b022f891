"""Order rows expanded into the events of their life."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.contract import (
    CANCELLED_LIFECYCLE,
    COMPLETED_LIFECYCLE,
    LIFECYCLE_STEP_MINUTES,
    event_type_of,
)


def expand_lifecycle(orders: DataFrame) -> DataFrame:
    """Rows with ``is_cancelled`` and ``started_at`` to one row per event.

    Adds step, order_status, event_type and event_time; all other columns of the
    order are carried to each of its events.
    """
    steps = F.when(
        F.col("is_cancelled"), F.array(*map(F.lit, CANCELLED_LIFECYCLE))
    ).otherwise(F.array(*map(F.lit, COMPLETED_LIFECYCLE)))
    carried = [c for c in orders.columns if c not in ("is_cancelled", "started_at")]
    offset = F.make_dt_interval(mins=F.col("step") * F.lit(LIFECYCLE_STEP_MINUTES))
    return orders.select(
        "*", F.posexplode(steps).alias("step", "order_status")
    ).select(
        *carried,
        "step",
        "order_status",
        event_type_of(F.col("order_status")).alias("event_type"),
        (F.col("started_at") + offset).alias("event_time"),
    )

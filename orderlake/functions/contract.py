"""Fixed values of the order event contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
EVENT_TYPES = ["order_created", "order_updated", "order_completed", "order_cancelled"]
ORDER_STATUSES = ["pending", "paid", "processing", "completed", "cancelled"]
STATUS_EVENT_TYPE = {
    "pending": "order_created",
    "paid": "order_updated",
    "processing": "order_updated",
    "completed": "order_completed",
    "cancelled": "order_cancelled",
}
COMPLETED_LIFECYCLE = ["pending", "paid", "processing", "completed"]
CANCELLED_LIFECYCLE = ["pending", "cancelled"]
LIFECYCLE_STEP_MINUTES = 5
DEFAULT_CURRENCY = "USD"
DEFAULT_EVENT_VERSION = 1
UUID_REGEX = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
CURRENCY_REGEX = "^[A-Z]{3}$"
# --------------------------------------------------------------------------


def event_type_of(status: Column) -> Column:
    """Event type that announces an order status; null for an unknown status."""
    pairs = [F.lit(text) for pair in STATUS_EVENT_TYPE.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), status)

"""Small literal frames for the tests."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from orderlake.operators.bronze import to_bronze
from orderlake.schemas import ENVELOPE

EVENT_ID = "3f2b8c1a-0d4e-4f6a-9b7c-1e2d3c4b5a69"
ORDER_ID = "a1b2c3d4-e5f6-4a7b-8c9d-0e1f2a3b4c5d"
CUSTOMER_ID = "0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f9"
GOOD = {
    "event_id": EVENT_ID,
    "event_type": "order_created",
    "event_version": 1,
    "order_id": ORDER_ID,
    "customer_id": CUSTOMER_ID,
    "order_status": "pending",
    "order_amount": "150.00",
    "currency": "USD",
    "event_time": "2026-08-01T10:15:00Z",
}
SENT = datetime(2026, 8, 1, 10, 15, 1, tzinfo=timezone.utc)


def event(**changes) -> str:
    """JSON of a good event with some fields changed; ``...`` leaves one out."""
    fields = {**GOOD, **changes}
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def messages(spark: SparkSession, values: list, key: str | None = ORDER_ID) -> DataFrame:
    """One message per value, in offset order; a pair gives the key as well."""
    rows = []
    for offset, item in enumerate(values):
        own_key, value = item if isinstance(item, tuple) else (key, item)
        rows.append(
            (
                None if own_key is None else own_key.encode(),
                None if value is None else value.encode(),
                "commerce.orders.v1",
                0,
                offset,
                SENT,
            )
        )
    return spark.createDataFrame(rows, ENVELOPE)


def bronze(spark: SparkSession, values: list) -> DataFrame:
    return to_bronze(messages(spark, values))

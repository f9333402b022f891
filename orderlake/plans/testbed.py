"""The given tables seen as order events, messages and orders.

Pure projections, so the same functions serve batch reads and streams. Faults
and redeliveries are decided by the event number; both only add or spoil rows,
they never leave any out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.contract import event_type_of
from orderlake.functions.wire import event_json
from orderlake.schemas import AMOUNT

TOPIC = "commerce.orders.v1"
#: One of every forty events per fault; fault n breaks lake rule n.
FAULT_CYCLE = 40
#: The fault that takes an event's time away.
TIMELESS_FAULT = 8
#: Every fiftieth event is delivered twice, the copy at a far higher offset.
REDELIVERY_CYCLE = 50
REDELIVERY_SHIFT = 1_000_000
EVENTS_STREAM_SCHEMA = (
    "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_events(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The events table as a stream.

    The bracket makes the path a glob: a file source takes a glob that matches
    one file or one directory, but no plain path to a single file.
    """
    reader = spark.readStream.schema(EVENTS_STREAM_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir}/events.parque[t]")


def _uuid(prefix: str, number: Column) -> Column:
    return F.concat(
        F.lit(f"{prefix}-0000-4000-8000-"), F.lpad(number.cast("string"), 12, "0")
    )


def order_events(raw: DataFrame) -> DataFrame:
    """events rows as typed order events with their transport position."""
    n, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    at = F.col("ts").cast("timestamp")
    status = (
        F.when(kind == "signup", "pending")
        .when(kind == "click", "paid")
        .when(kind == "view", "processing")
        .when(kind == "purchase", "completed")
        .when(kind == "error", "cancelled")
    )
    currency = F.when(user % 3 == 0, "USD").when(user % 3 == 1, "TWD").otherwise("EUR")
    order_id = _uuid("10000000", F.floor(n / 4))
    return raw.select(
        n.alias("n"),
        _uuid("00000000", n).alias("event_id"),
        event_type_of(status).alias("event_type"),
        F.lit(1).alias("event_version"),
        order_id.alias("order_id"),
        _uuid("20000000", user).alias("customer_id"),
        status.alias("order_status"),
        F.col("value").cast(AMOUNT).alias("order_amount"),
        currency.alias("currency"),
        at.alias("event_time"),
        order_id.alias("message_key"),
        F.lit(TOPIC).alias("kafka_topic"),
        (user % 3).cast("int").alias("kafka_partition"),
        n.alias("kafka_offset"),
        (at + F.expr("INTERVAL 1 SECOND")).alias("kafka_timestamp"),
    )


def spoil(events: DataFrame) -> DataFrame:
    """Break one rule in twenty of every forty events; adds ``fault``."""
    fault = F.col("fault")

    def when_fault(name: str, *changes: tuple[int, object]) -> Column:
        kind = events.schema[name].dataType
        changed = F.col(name)
        for number, value in changes:
            other = value if isinstance(value, Column) else F.lit(value)
            changed = F.when(fault == number, other.cast(kind)).otherwise(changed)
        return changed

    return events.withColumn("fault", (F.col("n") % FAULT_CYCLE).cast("int")).withColumns(
        {
            "event_id": when_fault("event_id", (2, None), (3, "not-a-uuid")),
            "order_id": when_fault("order_id", (4, None), (5, "not-a-uuid")),
            "customer_id": when_fault("customer_id", (6, None), (7, "not-a-uuid")),
            "event_time": when_fault("event_time", (TIMELESS_FAULT, None)),
            "event_version": when_fault("event_version", (9, None), (10, 0)),
            "event_type": when_fault("event_type", (11, None), (12, "order_teleported")),
            "order_status": when_fault("order_status", (13, None), (14, "shipped")),
            "order_amount": when_fault("order_amount", (15, None), (16, 0)),
            "currency": when_fault("currency", (17, None), (18, "usd")),
            "message_key": when_fault(
                "message_key", (5, "not-a-uuid"), (19, None), (20, F.col("customer_id"))
            ),
        }
    )


def spoil_text(messages: DataFrame) -> DataFrame:
    """Break three terms that only the text of a message can break, each in one of
    forty: a third decimal, a currency of four letters, a time without a zone."""
    fault, text = F.col("offset") % FAULT_CYCLE, F.col("value").cast("string")
    decimal = F.regexp_replace(text, r'("order_amount":"\d+\.\d\d)"', '$11"')
    letters = F.regexp_replace(text, r'("currency":"[A-Z]{3})"', '$1X"')
    zoneless = F.regexp_replace(text, r'("event_time":"[^"]+)Z"', '$1"')
    spoiled = F.when(fault == 22, decimal).when(fault == 23, letters).when(fault == 24, zoneless)
    return messages.withColumn("value", F.coalesce(spoiled, text).cast("binary"))


def redeliver(events: DataFrame) -> DataFrame:
    """Deliver some events a second time, as copies at another offset."""
    twice = F.array(F.lit(0), F.lit(REDELIVERY_SHIFT))
    shifts = F.when(F.col("n") % REDELIVERY_CYCLE == 0, twice).otherwise(F.array(F.lit(0)))
    return (
        events.select("*", F.explode(shifts).alias("_shift"))
        .withColumn("kafka_offset", F.col("kafka_offset") + F.col("_shift"))
        .drop("_shift")
    )


def as_messages(events: DataFrame) -> DataFrame:
    """Typed (maybe spoiled) events as transport messages with binary payload."""
    value = event_json()
    if "fault" in events.columns:
        value = F.when(F.col("fault") == 1, F.lit("this-is-not-json")).otherwise(value)
    return events.select(
        F.col("message_key").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def messages(raw: DataFrame) -> DataFrame:
    """events rows as messages: some spoiled, some delivered twice."""
    return as_messages(redeliver(spoil(order_events(raw))))


def lifecycle_orders(orders: DataFrame) -> DataFrame:
    """orders rows as the input of the lifecycle expansion."""
    return orders.select(
        _uuid("10000000", F.col("o_orderkey")).alias("order_id"),
        _uuid("20000000", F.col("o_custkey")).alias("customer_id"),
        F.col("o_totalprice").cast(AMOUNT).alias("order_amount"),
        (F.col("o_orderstatus") == "P").alias("is_cancelled"),
        F.col("o_orderdate").cast("timestamp").alias("started_at"),
    )

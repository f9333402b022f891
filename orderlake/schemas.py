"""Declared schemas of every dataset; nothing is inferred on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

AMOUNT = DecimalType(12, 2)
REVENUE = DecimalType(22, 2)
AVERAGE_VALUE = DecimalType(16, 6)
STORED_AVERAGE_VALUE = DecimalType(22, 6)


def _fields(required: bool, **types: DataType) -> list[StructField]:
    return [StructField(name, kind, not required) for name, kind in types.items()]


# Names and types of the event and of its place in the transport.
_EVENT = dict(
    event_id=StringType(),
    event_type=StringType(),
    event_version=IntegerType(),
    order_id=StringType(),
    customer_id=StringType(),
    order_status=StringType(),
    order_amount=AMOUNT,
    currency=StringType(),
    event_time=TimestampType(),
)
_POSITION = dict(
    kafka_topic=StringType(),
    kafka_partition=IntegerType(),
    kafka_offset=LongType(),
    kafka_timestamp=TimestampType(),
)

EVENT_COLUMNS = list(_EVENT)
POSITION_COLUMNS = list(_POSITION)

#: The JSON value of a message. Nullable: a bad field parses to null.
EVENT = StructType(_fields(False, **_EVENT))

#: What the transport delivers.
ENVELOPE = StructType(
    _fields(False, key=BinaryType(), value=BinaryType())
    + _fields(
        True,
        topic=StringType(),
        partition=IntegerType(),
        offset=LongType(),
        timestamp=TimestampType(),
    )
)

BRONZE = StructType(
    _fields(False, message_key=StringType(), raw_event=StringType())
    + _fields(True, **_POSITION)
    + _fields(False, **_EVENT)
    + _fields(True, is_valid_json=BooleanType(), ingested_at=TimestampType())
    + _fields(False, ingestion_date=DateType())
)

SILVER = StructType(
    _fields(True, **_EVENT)
    + _fields(False, message_key=StringType())
    + _fields(True, **_POSITION, ingested_at=TimestampType(), validated_at=TimestampType())
    + _fields(False, event_date=DateType())
)

QUARANTINE = StructType(
    _fields(False, raw_event=StringType())
    + _fields(True, validation_errors=ArrayType(StringType()))
    + _fields(False, message_key=StringType())
    + _fields(True, **_POSITION, ingested_at=TimestampType(), validated_at=TimestampType())
    + _fields(False, quarantine_date=DateType())
)

_METRICS = dict(
    window_start=TimestampType(),
    window_end=TimestampType(),
    currency=StringType(),
    order_event_count=LongType(),
    created_order_count=LongType(),
    completed_order_count=LongType(),
    revenue=REVENUE,
)
_STATUS = dict(
    window_start=TimestampType(),
    window_end=TimestampType(),
    currency=StringType(),
    order_status=StringType(),
    status_event_count=LongType(),
)

GOLD_METRICS = StructType(
    _fields(True, **_METRICS)
    + _fields(False, average_order_value=AVERAGE_VALUE)
    + _fields(True, aggregated_at=TimestampType())
    + _fields(False, window_date=DateType())
)
GOLD_STATUS = StructType(
    _fields(True, **_STATUS, aggregated_at=TimestampType())
    + _fields(False, window_date=DateType())
)

#: Reporting tables: gold without its partition column, plus the load time.
METRICS_TABLE = StructType(
    _fields(True, **_METRICS)
    + _fields(False, average_order_value=STORED_AVERAGE_VALUE)
    + _fields(True, aggregated_at=TimestampType(), loaded_at=TimestampType())
)
STATUS_TABLE = StructType(
    _fields(True, **_STATUS, aggregated_at=TimestampType(), loaded_at=TimestampType())
)
METRICS_KEY = ["window_start", "currency"]
STATUS_KEY = ["window_start", "currency", "order_status"]

#: Row store of accepted events. The currency lives only inside raw_event.
EVENT_STORE = StructType(
    _fields(
        True,
        **{name: kind for name, kind in _EVENT.items() if name != "currency"},
        ingested_at=TimestampType(),
        raw_event=StringType(),
    )
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the columns of ``schema``, cast to its types.

    A missing ``loaded_at`` or ``ingested_at`` takes its default, the current time.
    """
    have = set(df.columns)
    picked = []
    for field in schema.fields:
        if field.name in have:
            source = F.col(field.name)
        elif field.name in ("loaded_at", "ingested_at"):
            source = F.current_timestamp()
        else:
            raise ValueError(f"column {field.name} is missing")
        picked.append(source.cast(field.dataType).alias(field.name))
    return df.select(picked)

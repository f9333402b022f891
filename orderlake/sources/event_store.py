"""The store of accepted events: append-only, one row per event_id.

The store grows with the stream and is never rewritten. It has two parts, and readers
see both. Batches append to the first, laid out by event date and by a hash bucket of
the id, so that ids are looked up in their buckets only. A stream that keeps its ids in
its state writes the second, a folder for each micro-batch, which a replay overwrites.
Only the id column is read to find out what is already there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from orderlake.config import LakeConfig
from orderlake.functions.wire import event_json
from orderlake.operators.dedup import keep_first
from orderlake.schemas import EVENT_COLUMNS, EVENT_STORE, conform
from orderlake.sources.readers import scan, scan_if_available
from orderlake.sources.sinks import write_partitioned

#: Hash buckets of ids; part of the layout, so never to be changed for a store.
ID_BUCKETS = 16
_DATED = [*EVENT_STORE.fields, StructField("event_date", DateType())]
_BATCHES = StructType([*_DATED, StructField("id_bucket", IntegerType())])
_STREAMED = StructType([*_DATED, StructField("batch_id", IntegerType())])


def store_rows(events: DataFrame) -> DataFrame:
    """Accepted events in the shape of the store."""
    return conform(
        events.drop("ingested_at", "raw_event").withColumn("raw_event", event_json()),
        EVENT_STORE,
    )


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All stored events; no rows before the first insert.

    event_date, a layout column, is kept so that date filters prune folders.
    """
    parts = (_batches(spark, path), _streamed(spark, path))
    columns = [field.name for field in _DATED]
    return parts[0].select(columns).unionByName(parts[1].select(columns))


def _batches(spark: SparkSession, path: str) -> DataFrame:
    return scan_if_available(spark, LakeConfig.batch_part(path), _BATCHES)


def _streamed(spark: SparkSession, path: str) -> DataFrame:
    return scan_if_available(spark, LakeConfig.stream_part(path), _STREAMED)


def id_bucket() -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(ID_BUCKETS)).cast("int")


def batch_ids(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Ids that batches have stored, in the buckets that ``rows`` have ids of."""
    touched = [r.b for r in rows.select(id_bucket().alias("b")).distinct().collect()]
    return _batches(spark, path).filter(F.col("id_bucket").isin(touched)).select("event_id")


def absent_rows(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows whose event_id is not among ``ids``; ``rows`` has unique ids.

    The ids are first cut down to those in question. Both sides are files, so Spark
    knows their sizes and decides itself whether to broadcast.
    """
    known = ids.select("event_id").join(rows.select("event_id"), "event_id", "left_semi")
    return rows.join(known, "event_id", "left_anti")


def _staged(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Rows of the store's shape, written and read back in the caller's session: inside
    a stream the batch's own session runs without adaptive execution."""
    df.write.mode("overwrite").parquet(path)
    return scan(spark, path, EVENT_STORE)


def insert_if_absent(spark: SparkSession, events: DataFrame, path: str, staging: str) -> int:
    """Append the events that are not stored yet; returns how many were.

    The first delivery of an id wins, within the batch and across batches, whoever
    stored it. Safe to repeat: what an interrupted run already appended is found and
    left out. ``staging`` holds the batch while it is compared, and is overwritten by
    the next one. One writer at a time.
    """
    delivery = ["kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset"]
    present = [F.col(name) for name in delivery if name in events.columns]
    by_content = [F.col(name) for name in ("event_time", *EVENT_COLUMNS)]
    first = keep_first(events, ["event_id"], present or by_content)
    rows = _staged(spark, store_rows(first), f"{staging}/batch")
    ids = batch_ids(spark, path, rows).union(_streamed(spark, path).select("event_id"))
    # Appending from the staged rows keeps the time short in which a crash could
    # leave the batch half there. Counts come from the file footers.
    absent = _staged(spark, absent_rows(ids, rows), f"{staging}/fresh")
    inserted = absent.count()
    if inserted:
        dated = absent.withColumns(
            {"event_date": F.to_date("event_time"), "id_bucket": id_bucket()}
        )
        write_partitioned(
            dated, LakeConfig.batch_part(path), "event_date", "id_bucket", mode="append"
        )
    return inserted


def append_batch(
    spark: SparkSession, events: DataFrame, path: str, staging: str, batch_id: int
) -> int:
    """Write a micro-batch of ids that its stream has not seen before as one folder.

    Ids that batches have stored are left out. A replay of the micro-batch overwrites
    its folder.
    """
    rows = _staged(spark, store_rows(events), f"{staging}/batch")
    fresh = _staged(spark, absent_rows(batch_ids(spark, path, rows), rows), f"{staging}/fresh")
    write_partitioned(
        fresh.withColumn("event_date", F.to_date("event_time")),
        f"{LakeConfig.stream_part(path)}/batch_id={batch_id}",
        "event_date",
    )
    return fresh.count()

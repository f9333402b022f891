"""Sinks: partitioned Parquet in batch, and keyed messages to Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from orderlake.functions.wire import to_messages


def write_partitioned(
    df: DataFrame, path: str, *partition_columns: str, mode: str = "overwrite"
) -> None:
    """Batch write of a dataset in folders, by date above all.

    The rebalance makes few large files per date; a date that holds much of the
    data is split over several tasks, small ones are merged.
    """
    df.hint("rebalance", *partition_columns).write.mode(mode).partitionBy(
        *partition_columns
    ).parquet(path)


def kafka_sink_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    """Idempotent delivery, confirmed by all replicas; an undelivered message
    fails the write."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def publish(events: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Send a batch of events as keyed JSON; needs the Spark Kafka connector."""
    options = kafka_sink_options(bootstrap_servers, topic)
    to_messages(events).write.format("kafka").options(**options).save()


def start_publish(
    events: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Send a stream of events as keyed JSON; needs the Spark Kafka connector."""
    options = kafka_sink_options(bootstrap_servers, topic)
    return (
        to_messages(events)
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )

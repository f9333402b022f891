"""Starting, bounding and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from orderlake.config import LakeConfig
from orderlake.session import session_settings


def _trigger(writer: DataStreamWriter, config: LakeConfig, bounded: bool) -> DataStreamWriter:
    if bounded:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=config.trigger_interval)


def _start(spark: SparkSession, config: LakeConfig, writer: DataStreamWriter) -> StreamingQuery:
    settings = {}
    if config.state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(config.state_partitions)
    with session_settings(spark, settings):
        return writer.start()


def gather(df: DataFrame, date_column: str, files: int, split_by: str) -> DataFrame:
    """Bring the rows of a date to at most ``files`` tasks, and so to as many files.

    The split by a hash keeps a date that holds much of a batch from ending up in
    a single task.
    """
    if files == 1:
        return df.repartition(date_column)
    return df.repartition(date_column, F.pmod(F.xxhash64(split_by), F.lit(files)))


def start_files(
    df: DataFrame,
    config: LakeConfig,
    *,
    name: str,
    path: str,
    partition_column: str,
    bounded: bool = False,
) -> StreamingQuery:
    """Append a stream to a dated Parquet dataset, each row exactly once.

    ``bounded`` works off what is there and ends; otherwise the query runs on
    its processing-time trigger until it is stopped.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("path", path)
        .option("checkpointLocation", config.checkpoint(name))
        .partitionBy(partition_column)
    )
    return _start(df.sparkSession, config, _trigger(writer, config, bounded))


def start_batches(
    df: DataFrame,
    config: LakeConfig,
    *,
    name: str,
    handle: Callable[[DataFrame, int], None],
    bounded: bool = False,
) -> StreamingQuery:
    """Hand each micro-batch to ``handle``.

    The source position is committed only after ``handle`` returned, so a failed
    batch comes again; ``handle`` must bear that.
    """
    writer = (
        df.writeStream.foreachBatch(handle)
        .queryName(name)
        .option("checkpointLocation", config.checkpoint(name))
    )
    return _start(df.sparkSession, config, _trigger(writer, config, bounded))


def finish(*queries: StreamingQuery) -> None:
    """Wait for bounded queries to end; raises what made one of them fail."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def wait_for_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until one of the session's queries ends, then stop the given ones."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()

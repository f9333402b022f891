"""The whole lake: messages to gold, as streams or in one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake.config import LakeConfig
from orderlake.operators.bronze import to_bronze
from orderlake.operators.gold import hourly_facts, metrics_from_facts, status_from_facts
from orderlake.operators.silver import to_quarantine, to_silver
from orderlake.schemas import BRONZE, SILVER
from orderlake.sources.readers import ensure_dataset, is_written, scan, stream_kafka
from orderlake.sources.sinks import write_partitioned
from orderlake.streaming.lake import start_bronze, start_gold, start_silver
from orderlake.streaming.runner import finish, wait_for_any


def run_lake(
    spark: SparkSession,
    config: LakeConfig,
    messages: DataFrame | None = None,
    *,
    bounded: bool = False,
) -> None:
    """Run all streaming hops; ``messages`` defaults to the Kafka topic.

    Bounded: each hop works off its input and ends before the next one starts.
    Otherwise all hops run side by side until one of them ends.
    """
    if messages is None:
        messages = stream_kafka(
            spark,
            config.bootstrap_servers,
            config.topic,
            config.max_offsets_per_trigger,
            config.min_partitions,
        )
    if bounded:
        finish(start_bronze(messages, config, bounded=True))
        finish(*start_silver(spark, config, bounded=True))
        finish(*start_gold(spark, config, bounded=True))
        return
    ensure_dataset(spark, config.stream_part(config.bronze), BRONZE, "ingestion_date")
    ensure_dataset(spark, config.stream_part(config.silver), SILVER, "event_date")
    spark.streams.resetTerminated()
    queries = [
        start_bronze(messages, config),
        *start_silver(spark, config),
        *start_gold(spark, config),
    ]
    wait_for_any(spark, queries)


def build_lake(spark: SparkSession, config: LakeConfig, messages: DataFrame) -> None:
    """Build the lake from a finite set of messages, replacing what is there.

    All windows count as final here, and one event_id is kept over the whole
    input. Both gold sets come from a single scan of silver. Streams may go on from
    here on the same root; once they have, a new build is refused, as it could not
    take back what they counted.
    """
    for dataset, schema in ((config.bronze, BRONZE), (config.silver, SILVER)):
        if is_written(spark, config.stream_part(dataset), schema):
            raise ValueError(f"streams have written to {dataset}: build into another root")
    built = config.batch_part
    # One ingestion date per run: the tasks' own partitioning is fine as it is.
    to_bronze(messages).write.mode("overwrite").partitionBy("ingestion_date").parquet(
        built(config.bronze)
    )
    bronze = scan(spark, built(config.bronze), BRONZE)
    write_partitioned(to_silver(bronze), built(config.silver), "event_date")
    to_quarantine(bronze).write.mode("overwrite").partitionBy("quarantine_date").parquet(
        built(config.quarantine)
    )
    build_gold(spark, config, scan(spark, built(config.silver), SILVER))


def build_gold(spark: SparkSession, config: LakeConfig, silver: DataFrame) -> None:
    """Both gold sets of a finite silver set, from one pass over it."""
    facts = write_facts(spark, silver, f"{config.root}/staging/hourly_facts", config.window)
    for frame, dataset in (
        (metrics_from_facts(facts), config.gold_metrics),
        (status_from_facts(facts), config.gold_status),
    ):
        write_partitioned(frame, config.batch_part(dataset), "window_date")


def write_facts(
    spark: SparkSession, silver: DataFrame, path: str, window: str = "1 hour"
) -> DataFrame:
    """Hourly facts as a written table: small, and safe from lost executors."""
    facts = hourly_facts(silver, window)
    facts.write.mode("overwrite").parquet(path)
    return scan(spark, path, facts.schema)

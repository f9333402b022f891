"""The streaming hops of the lake, each from dataset to dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.config import LakeConfig
from orderlake.functions.strict import accepted, apply_contract
from orderlake.operators.bronze import envelope, to_bronze
from orderlake.operators.gold import hourly_facts, metrics_from_facts, status_from_facts
from orderlake.operators.silver import to_quarantine, to_silver
from orderlake.schemas import (
    BRONZE,
    EVENT_STORE,
    GOLD_METRICS,
    GOLD_STATUS,
    POSITION_COLUMNS,
    SILVER,
)
from orderlake.sources.event_store import append_batch, insert_if_absent
from orderlake.sources.readers import is_written, require_checkpoint, scan, stream_parquet
from orderlake.sources.sinks import write_partitioned
from orderlake.streaming.runner import gather, start_batches, start_files


def start_bronze(
    messages: DataFrame, config: LakeConfig, bounded: bool = False
) -> StreamingQuery:
    """Messages to bronze."""
    return start_files(
        to_bronze(messages),
        config,
        name="bronze_orders",
        path=config.stream_part(config.bronze),
        partition_column="ingestion_date",
        bounded=bounded,
    )


def start_silver(
    spark: SparkSession, config: LakeConfig, bounded: bool = False
) -> list[StreamingQuery]:
    """Bronze to silver and quarantine: two queries over one source.

    They are separate because only silver carries state. Each reads just its own
    columns; silver never touches the raw text. Events that a batch build has written
    are left out.
    """
    bronze = stream_parquet(
        spark, config.stream_part(config.bronze), BRONZE, config.max_files_per_trigger
    )
    valid = to_silver(bronze, config.silver_delay)
    built = config.batch_part(config.silver)
    if is_written(spark, built, SILVER):
        known = scan(spark, built, SILVER)
        if config.backfill_since is not None:
            known = known.filter(F.col("event_date") >= F.lit(config.backfill_since).cast("date"))
        valid = valid.join(known.select("event_id"), "event_id", "left_anti").select(
            SILVER.fieldNames()
        )
    if config.silver_files_per_date is not None:
        valid = gather(valid, "event_date", config.silver_files_per_date, split_by="event_id")
    silver = start_files(
        valid,
        config,
        name="silver_orders",
        path=config.stream_part(config.silver),
        partition_column="event_date",
        bounded=bounded,
    )
    quarantine = start_files(
        to_quarantine(bronze),
        config,
        name="quarantine_orders",
        path=config.stream_part(config.quarantine),
        partition_column="quarantine_date",
        bounded=bounded,
    )
    return [silver, quarantine]


def start_gold(
    spark: SparkSession, config: LakeConfig, bounded: bool = False
) -> list[StreamingQuery]:
    """Silver to both gold aggregates; a window is written once it is final.

    One query counts the hourly facts under both, so silver is read once and both sets
    agree on what came too late. A micro-batch is a folder of each set, which a replay
    overwrites. The metrics are written last: whatever windows they show, the status
    counts are there.

    Events of a batch build are counted too, so that a window that both have events of
    is whole. They all belong to the first micro-batch, when nothing is late yet.
    """
    name, staging = "gold_orders", f"{config.root}/staging/gold_orders"
    for dataset, schema in ((config.gold_metrics, GOLD_METRICS), (config.gold_status, GOLD_STATUS)):
        require_checkpoint(spark, config.checkpoint(name), dataset, schema)
    silver = stream_parquet(
        spark, config.stream_part(config.silver), SILVER, config.max_files_per_trigger
    )
    built = config.batch_part(config.silver)
    if is_written(spark, built, SILVER):
        silver = silver.unionByName(stream_parquet(spark, built, SILVER, None))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(staging)
        facts = scan(spark, staging, batch.schema)
        if facts.isEmpty():
            return
        for frame, dataset in (
            (status_from_facts(facts), config.gold_status),
            (metrics_from_facts(facts), config.gold_metrics),
        ):
            folder = f"{config.stream_part(dataset)}/batch_id={batch_id}"
            write_partitioned(frame, folder, "window_date")

    facts = hourly_facts(silver, config.window, config.gold_delay)
    return [start_batches(facts, config, name=name, handle=write, bounded=bounded)]


def start_event_store(
    messages: DataFrame,
    config: LakeConfig,
    bounded: bool = False,
    *,
    ids_in_state: bool | None = None,
) -> StreamingQuery:
    """Messages that meet the strict contract to the event store.

    Anything else is left out and does not stop the stream; :func:`start_rejects` keeps
    it. With ``ids_in_state``, the default of continuous runs, the ids of the stream are
    in its state, and a micro-batch looks up only what others have inserted, in the
    buckets of its ids; it is one folder of the store, which a replay overwrites.
    Otherwise, the default of bounded runs, a micro-batch is inserted like any batch.
    """
    spark = messages.sparkSession
    staging = f"{config.root}/staging/event_store"
    events = accepted(apply_contract(envelope(messages)))
    if ids_in_state is None:
        ids_in_state = not bounded
    if not ids_in_state:

        def handle(batch: DataFrame, batch_id: int) -> None:
            insert_if_absent(spark, batch, config.event_store, staging)

        return start_batches(events, config, name="event_store", handle=handle, bounded=bounded)

    name = "event_store_state"
    require_checkpoint(spark, config.checkpoint(name), config.event_store, EVENT_STORE)

    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(spark, batch, config.event_store, f"{staging}_state", batch_id)

    single = events.dropDuplicates(["event_id"])
    return start_batches(single, config, name=name, handle=append, bounded=bounded)


def start_rejects(
    messages: DataFrame, config: LakeConfig, bounded: bool = False
) -> StreamingQuery:
    """Messages that the strict contract refuses: their position and every code."""
    checked = apply_contract(envelope(messages))
    refused = checked.filter(F.size("contract_errors") > 0).select(
        *POSITION_COLUMNS,
        "contract_errors",
        F.to_date("kafka_timestamp").alias("rejected_date"),
    )
    return start_files(
        refused,
        config,
        name="event_store_rejects",
        path=config.rejects,
        partition_column="rejected_date",
        bounded=bounded,
    )

"""Settings of one lake: where its data lies and how its streams behave."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakeConfig:
    """Paths hang off ``root``; every path may be any Hadoop-readable URI."""

    root: str
    topic: str = "commerce.orders.v1"
    bootstrap_servers: str = "broker:9092"
    silver_delay: str = "7 days"
    gold_delay: str = "1 day"
    window: str = "1 hour"
    #: Processing-time trigger of continuous runs; bounded runs ignore it.
    trigger_interval: str = "10 seconds"
    #: Rate limit of the Parquet sources. None takes all that is there at once,
    #: which is what a backfill wants: one large batch instead of thousands.
    max_files_per_trigger: int | None = 10
    #: Partitions of stateful streaming shuffles; frozen into the checkpoint on
    #: the first run, so size it for peak load. None uses the session's value.
    state_partitions: int | None = None
    #: Files a silver micro-batch may write per event date; also the most tasks that
    #: write it. None lets every state partition write the dates it holds, which uses
    #: the whole cluster; compact old dates later. Set it where batches are small.
    silver_files_per_date: int | None = None
    #: Bounds of a Kafka micro-batch, and of its splits. Without the first, the first
    #: batch is the whole topic.
    max_offsets_per_trigger: int | None = 10_000_000
    min_partitions: int | None = None
    #: Where a batch build lies beside the streams, silver leaves out the events it has
    #: written. Its dates before this one (ISO) are not looked at; None looks at all.
    backfill_since: str | None = None
    #: How many published generations of the reporting tables stay readable.
    keep_generations: int = 3

    # Batch writers and streams have folders of their own below each dataset: a
    # stream's folder is read by the log of what the stream has committed, so rows
    # that others put there would not be seen.

    @staticmethod
    def batch_part(dataset: str) -> str:
        return f"{dataset}/batch"

    @staticmethod
    def stream_part(dataset: str) -> str:
        return f"{dataset}/stream"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/order_events"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/order_events"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine/order_events"

    @property
    def gold_metrics(self) -> str:
        return f"{self.root}/gold/order_metrics"

    @property
    def gold_status(self) -> str:
        return f"{self.root}/gold/order_status_distribution"

    @property
    def reporting(self) -> str:
        return f"{self.root}/reporting"

    @property
    def event_store(self) -> str:
        return f"{self.root}/store/order_events"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects/order_events"

    def checkpoint(self, query_name: str) -> str:
        return f"{self.root}/checkpoints/{query_name}"

"""Every operator of the engine as a runnable query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from orderlake.config import LakeConfig
from orderlake.functions.rules import with_validation
from orderlake.functions.strict import accepted, apply_contract
from orderlake.functions.times import to_utc
from orderlake.functions.wire import to_messages
from orderlake.operators import quality, reports
from orderlake.operators.bronze import envelope, parse_payload, to_bronze
from orderlake.operators.dedup import dedup_events
from orderlake.operators.gold import (
    metrics_from_facts,
    order_metrics,
    status_distribution,
    status_from_facts,
)
from orderlake.operators.lifecycle import expand_lifecycle
from orderlake.operators.mart import hourly_mart, pivot_status, stage_metrics, stage_status
from orderlake.operators.silver import select_valid, to_quarantine, to_silver
from orderlake.operators.upsert import upsert_metrics, upsert_status
from orderlake.plans import testbed
from orderlake.plans.lake import build_gold, build_lake, run_lake, write_facts
from orderlake.plans.refresh import (
    MART,
    METRICS,
    STATUS,
    refresh_marts,
    reporting_frames,
)
from orderlake.schemas import (
    EVENT_COLUMNS,
    GOLD_METRICS,
    GOLD_STATUS,
    METRICS_KEY,
    METRICS_TABLE,
    POSITION_COLUMNS,
    QUARANTINE,
    SILVER,
    STATUS_KEY,
    STATUS_TABLE,
    conform,
)
from orderlake.session import scratch_path
from orderlake.sources.catalog import register_views, table_row_counts
from orderlake.sources.event_store import insert_if_absent, read_store, store_rows
from orderlake.sources.readers import (
    scan,
    scan_final,
    scan_if_available,
    scan_parts,
    scan_pruned,
    stream_parquet,
)
from orderlake.streaming.lake import (
    start_bronze,
    start_event_store,
    start_rejects,
    start_silver,
)
from orderlake.streaming.runner import finish, start_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

METRIC_COLUMNS = [n for n in GOLD_METRICS.fieldNames() if n not in ("aggregated_at", "window_date")]
STATUS_COLUMNS = [n for n in GOLD_STATUS.fieldNames() if n not in ("aggregated_at", "window_date")]
STORE = "order_events"
CLOCK_COLUMNS = ["ingested_at", "validated_at", "aggregated_at", "loaded_at"]


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; it runs in UTC and returns zoneless times, no clocks."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = function(spark, sf_dir).drop(*CLOCK_COLUMNS)
            kinds = {f.name: f.dataType for f in df.schema.fields}
            instants = [n for n, kind in kinds.items() if isinstance(kind, TimestampType)]
            return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in instants})

        QUERIES[name] = run
        return function

    return register


# -- inputs ---------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.read_table(spark, sf_dir, "events")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.order_events(_raw(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.messages(_raw(spark, sf_dir))


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.messages(testbed.stream_events(spark, sf_dir))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as the dataset it is: written once, then read with pushdown.

    In one plan with the parse, a filter on the parsed fields would sink below it
    and repeat the parse for every term.
    """
    return _written(spark, to_bronze(_messages(spark, sf_dir)), "bronze")


def _config(spark: SparkSession, name: str) -> LakeConfig:
    """A fresh lake in the shared scratch folder, for bounded runs.

    No rate limit, so a hop is one batch whatever the number of files.
    """
    return LakeConfig(root=scratch_path(spark, name), max_files_per_trigger=None)


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly facts of all events, written once: the tables below are rolled up
    from them, so that a query over several tables scans the events once."""
    path = scratch_path(spark, "hourly_facts")
    return write_facts(spark, _events(spark, sf_dir), path)


def _metrics_table(facts: DataFrame) -> DataFrame:
    return conform(metrics_from_facts(facts), METRICS_TABLE)


def _status_table(facts: DataFrame) -> DataFrame:
    return conform(status_from_facts(facts), STATUS_TABLE)


def _reporting(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    facts = _facts(spark, sf_dir)
    return reporting_frames(_metrics_table(facts), _status_table(facts))


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return scan(spark, path, df.schema)


# -- sources and sinks ------------------------------------------------------------


@query("scan_parquet")
def scan_parquet(spark, sf_dir):
    return _events(spark, sf_dir).drop("n")


@query("stream_parquet_source")
def stream_parquet_source(spark, sf_dir):
    config = _config(spark, "stream_source")
    events = testbed.order_events(testbed.stream_events(spark, sf_dir, 10))
    picked = events.select(*EVENT_COLUMNS, F.to_date("event_time").alias("event_date"))
    finish(
        start_files(
            picked,
            config,
            name="stream_source",
            path=config.silver,
            partition_column="event_date",
            bounded=True,
        )
    )
    return scan(spark, config.silver, picked.schema)


@query("stream_partitioned_sink")
def stream_partitioned_sink(spark, sf_dir):
    config = _config(spark, "stream_sink")
    bronze = to_bronze(_message_stream(spark, sf_dir))
    dated = bronze.withColumn("sent_date", F.to_date("kafka_timestamp"))
    finish(
        start_files(
            dated,
            config,
            name="stream_sink",
            path=config.bronze,
            partition_column="sent_date",
            bounded=True,
        )
    )
    return (
        scan(spark, config.bronze, dated.schema)
        .groupBy("sent_date")
        .agg(
            F.count("*").alias("messages"),
            F.count_if("is_valid_json").alias("json_messages"),
            F.sum("order_amount").cast("decimal(22,2)").alias("amount"),
        )
    )


@query("scan_pruned_gold")
def scan_pruned_gold(spark, sf_dir):
    config = _config(spark, "pruned_gold")
    build_gold(spark, config, _events(spark, sf_dir))
    return scan_pruned(
        spark,
        config.batch_part(config.gold_metrics),
        ["window_start", "currency", "revenue"],
        partition_column="window_date",
        since="2024-01-10",
    )


@query("upsert_metrics")
def upsert_metrics_table(spark, sf_dir):
    """Held: USD and TWD. Arriving: TWD and EUR with raised counts, and an older
    copy of each arriving row that must lose."""
    metrics = metrics_from_facts(_facts(spark, sf_dir))
    held = conform(metrics.filter("currency <> 'EUR'"), METRICS_TABLE)
    arriving = metrics.filter("currency <> 'USD'").withColumn(
        "order_event_count", F.col("order_event_count") + 1000
    )
    older = arriving.withColumn("order_event_count", F.lit(-1).cast("long")).withColumn(
        "aggregated_at", F.col("aggregated_at") - F.expr("INTERVAL 1 HOUR")
    )
    return upsert_metrics(held, arriving.unionByName(older)).select(METRIC_COLUMNS)


@query("upsert_status")
def upsert_status_table(spark, sf_dir):
    """Held: all but completed. Arriving: all but pending, with raised counts."""
    status = status_from_facts(_facts(spark, sf_dir))
    held = conform(status.filter("order_status <> 'completed'"), STATUS_TABLE)
    arriving = status.filter("order_status <> 'pending'").withColumn(
        "status_event_count", F.col("status_event_count") + 1000
    )
    return upsert_status(held, arriving).select(STATUS_COLUMNS)


def _filled_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the USD events, then all events twice over at another amount."""
    config = _config(spark, "insert_if_absent")
    events = _events(spark, sf_dir).drop("n", "message_key")
    changed = events.withColumn("order_amount", (F.col("order_amount") + 1).cast("decimal(12,2)"))
    again = changed.withColumns(
        {
            "order_amount": (F.col("order_amount") + 1).cast("decimal(12,2)"),
            "kafka_offset": F.col("kafka_offset") + testbed.REDELIVERY_SHIFT,
        }
    )
    staging = f"{config.root}/staging"
    insert_if_absent(spark, events.filter("currency = 'USD'"), config.event_store, staging)
    insert_if_absent(spark, changed.unionByName(again), config.event_store, staging)
    return read_store(spark, config.event_store)


@query("insert_if_absent")
def insert_if_absent_store(spark, sf_dir):
    stored = _filled_store(spark, sf_dir)
    return stored.select("event_id", "order_id", "order_status", "order_amount", "event_time")


@query("recent_store_events")
def recent_store_events(spark, sf_dir):
    config = _config(spark, "recent_store")
    events = _events(spark, sf_dir).drop("n", "message_key")
    insert_if_absent(spark, events, config.event_store, f"{config.root}/staging")
    return reports.recent_store_events(read_store(spark, config.event_store))


@query("stored_count")
def stored_count(spark, sf_dir):
    """Of an event that arrives twice in each of two inserts."""
    stored = _filled_store(spark, sf_dir)
    return reports.stored_count(stored, "00000000-0000-4000-8000-000000000100")


@query("publish_envelope")
def publish_envelope(spark, sf_dir):
    return to_messages(_events(spark, sf_dir))


@query("event_store_stream")
def event_store_stream(spark, sf_dir):
    config = _config(spark, "event_store")
    finish(start_event_store(_message_stream(spark, sf_dir), config, bounded=True))
    return _as_sent(read_store(spark, config.event_store))


def _as_sent(stored: DataFrame) -> DataFrame:
    """Stored events; ids and times that were made up are left out."""
    given = F.col("event_id").startswith("00000000-0000-4000-8000-")
    number = F.substring("event_id", 25, 12).try_cast("bigint")
    timeless = given & (number % testbed.FAULT_CYCLE == testbed.TIMELESS_FAULT)
    currency = F.get_json_object("raw_event", "$.currency")
    return stored.select(
        F.when(given, F.col("event_id")).alias("event_id"),
        F.when(~timeless, F.col("event_time")).alias("event_time"),
        "event_type",
        "event_version",
        "order_id",
        "customer_id",
        "order_status",
        "order_amount",
        currency.alias("currency"),
    )


def _of_partitions(messages: DataFrame, *partitions: int) -> DataFrame:
    return messages.filter(F.col("partition").isin(*partitions))


@query("event_store_mixed_writers")
def event_store_mixed_writers(spark, sf_dir):
    """A batch, a stream with its ids in state, and all of it as a batch again.

    Each takes up some of what the one before has stored; the last adds nothing.
    The batches are of the same messages, which are checked once and written.
    """
    config = _config(spark, "mixed_store")
    staging = f"{config.root}/staging/batch"
    checked = apply_contract(envelope(_messages(spark, sf_dir)))
    batch = _written(spark, accepted(checked).drop("raw_event", "message_key"), "accepted")

    def insert(events: DataFrame) -> int:
        return insert_if_absent(spark, events, config.event_store, staging)

    first = insert(batch.filter("kafka_partition = 0"))
    second = _of_partitions(_message_stream(spark, sf_dir), 0, 1)
    finish(start_event_store(second, config, bounded=True, ids_in_state=True))
    streamed = read_store(spark, config.event_store).count() - first
    third = insert(batch)
    repeated = insert(batch)
    stored = read_store(spark, config.event_store)
    return _as_sent(stored).select(
        "*",
        (F.lit(first + streamed + third) == stored.count()).alias("counts_add_up"),
        F.lit(repeated).cast("bigint").alias("inserted_again"),
    )


@query("event_store_outcome")
def event_store_outcome(spark, sf_dir):
    """What became of the messages: rejects of each code, and events stored."""
    config = _config(spark, "outcome")
    stream = _message_stream(spark, sf_dir)
    finish(
        start_event_store(stream, config, bounded=True),
        start_rejects(stream, config, bounded=True),
    )
    rejects = scan_if_available(
        spark, config.rejects, StructType.fromDDL("contract_errors array<string>")
    )
    codes = rejects.select(F.explode("contract_errors").alias("outcome"))
    stored = read_store(spark, config.event_store).select(F.lit("stored").alias("outcome"))
    return codes.union(stored).groupBy("outcome").agg(F.count("*").alias("messages"))


@query("poison_tolerance")
def poison_tolerance(spark, sf_dir):
    """Null and unreadable payloads between good ones; ids kept in state."""
    config = _config(spark, "poison")
    stream = _message_stream(spark, sf_dir)
    tombstone = F.col("offset") % testbed.FAULT_CYCLE == 21
    poisoned = stream.withColumn("value", F.when(~tombstone, F.col("value")))
    finish(start_event_store(poisoned, config, bounded=True, ids_in_state=True))
    return (
        read_store(spark, config.event_store)
        .groupBy("order_status", "event_type")
        .agg(F.count("*").alias("stored"), F.count_distinct("event_id").alias("ids"))
    )


@query("materialize_mart")
def materialize_mart(spark, sf_dir):
    return _written(spark, _reporting(spark, sf_dir)[MART], "mart")


@query("table_row_counts_of_database")
def table_row_counts_of_database(spark, sf_dir):
    """Tables of a named database, while a view of the session goes by another name."""
    database = f"reporting_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for name, df in _reporting(spark, sf_dir).items():
        df.write.saveAsTable(f"{database}.{name}")
    register_views({"not_of_that_database": spark.range(1)})
    return table_row_counts(spark, database)


@query("table_row_counts")
def table_row_counts_of_views(spark, sf_dir):
    frames = _reporting(spark, sf_dir)
    register_views({f"reporting_{name}": df for name, df in frames.items()})
    return table_row_counts(spark, pattern="reporting_*")


# -- projections and parsing --------------------------------------------------------


@query("bronze_envelope")
def bronze_envelope(spark, sf_dir):
    return envelope(_messages(spark, sf_dir))


@query("json_validity")
def json_validity(spark, sf_dir):
    parsed = parse_payload(envelope(_messages(spark, sf_dir)))
    return parsed.select("kafka_partition", "kafka_offset", "is_valid_json")


@query("bronze_parse")
def bronze_parse(spark, sf_dir):
    parsed = parse_payload(envelope(_messages(spark, sf_dir)))
    return parsed.select("kafka_partition", "kafka_offset", *EVENT_COLUMNS)


@query("silver_events")
def silver_events(spark, sf_dir):
    return to_silver(_bronze(spark, sf_dir))


@query("quarantine_events")
def quarantine_events(spark, sf_dir):
    return (
        to_quarantine(_bronze(spark, sf_dir))
        .drop("quarantine_date")
        .withColumn("validation_errors", F.array_join("validation_errors", ","))
    )


@query("valid_invalid_split")
def valid_invalid_split(spark, sf_dir):
    checked = with_validation(_bronze(spark, sf_dir))
    return checked.groupBy("is_valid").agg(F.count("*").alias("messages"))


@query("stg_metrics")
def stg_metrics(spark, sf_dir):
    return stage_metrics(_metrics_table(_facts(spark, sf_dir)))


@query("stg_status")
def stg_status(spark, sf_dir):
    return stage_status(_status_table(_facts(spark, sf_dir)))


@query("utc_normalize")
def utc_normalize(spark, sf_dir):
    raw = _raw(spark, sf_dir).select("event_id", F.col("ts").alias("assumed_utc"))
    both = raw.withColumn("from_taipei", F.col("assumed_utc"))
    return to_utc(to_utc(both, "assumed_utc"), "from_taipei", source_zone="Asia/Taipei")


@query("contract_normalize")
def contract_normalize(spark, sf_dir):
    """Spellings the contract repairs: bare upper-case ids, padded lower-case
    currencies, numbers as text, times with an offset."""
    events = _events(spark, sf_dir)
    text = F.to_json(
        F.struct(
            F.upper(F.replace("event_id", F.lit("-"))).alias("event_id"),
            "event_type",
            F.col("event_version").cast("string").alias("event_version"),
            F.concat(F.lit("urn:uuid:"), "order_id").alias("order_id"),
            F.concat(F.lit("{"), "customer_id", F.lit("}")).alias("customer_id"),
            "order_status",
            "order_amount",
            F.concat(F.lit(" "), F.lower("currency"), F.lit(" ")).alias("currency"),
            F.concat(
                F.date_format(
                    F.col("event_time") + F.expr("INTERVAL 8 HOURS"),
                    "yyyy-MM-dd HH:mm:ss.SSSSSS",
                ),
                F.lit("+0800"),
            ).alias("event_time"),
        )
    )
    return accepted(apply_contract(events.select(text.alias("raw_event")))).drop("raw_event")


@query("status_to_event_type")
def status_to_event_type(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", "order_status", "event_type")


@query("lifecycle_expand")
def lifecycle_expand(spark, sf_dir):
    orders = testbed.read_table(spark, sf_dir, "orders")
    return expand_lifecycle(testbed.lifecycle_orders(orders))


# -- validation -----------------------------------------------------------------------


@query("validation_errors")
def validation_errors(spark, sf_dir):
    return with_validation(_bronze(spark, sf_dir)).select(
        "kafka_partition",
        "kafka_offset",
        F.array_join("validation_errors", ",").alias("validation_errors"),
        "is_valid",
    )


@query("validation_error_counts")
def validation_error_counts(spark, sf_dir):
    codes = with_validation(_bronze(spark, sf_dir)).filter(~F.col("is_valid"))
    return (
        codes.select(F.explode("validation_errors").alias("code"))
        .groupBy("code")
        .agg(F.count("*").alias("messages"))
    )


@query("strict_contract")
def strict_contract(spark, sf_dir):
    messages = testbed.spoil_text(_messages(spark, sf_dir))
    return apply_contract(envelope(messages)).select(
        "kafka_partition",
        "kafka_offset",
        F.array_join("contract_errors", ",").alias("contract_errors"),
    )


# -- aggregates and joins ---------------------------------------------------------------


@query("gold_order_metrics")
def gold_order_metrics(spark, sf_dir):
    return order_metrics(_events(spark, sf_dir))


@query("gold_status_distribution")
def gold_status_distribution(spark, sf_dir):
    return status_distribution(_events(spark, sf_dir))


@query("status_pivot")
def status_pivot(spark, sf_dir):
    return pivot_status(stage_status(_status_table(_facts(spark, sf_dir))))


@query("mart_hourly")
def mart_hourly(spark, sf_dir):
    """All metrics, and once more at a time without any status, where counts are 0."""
    facts = _facts(spark, sf_dir)
    metrics, later = _metrics_table(facts), F.expr("INTERVAL 1000 DAYS")
    moved = {c: F.col(c) + later for c in ("window_start", "window_end")}
    both = metrics.unionByName(metrics.withColumns(moved))
    return hourly_mart(stage_metrics(both), stage_status(_status_table(facts)))


@query("duplicate_event_ids")
def duplicate_event_ids(spark, sf_dir):
    valid = select_valid(_bronze(spark, sf_dir))
    return reports.duplicate_key_count(valid, "event_id")


@query("row_counts")
def row_counts(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    facts = _facts(spark, sf_dir)
    return reports.row_counts(
        {
            "bronze": bronze,
            "silver": to_silver(bronze),
            "quarantine": to_quarantine(bronze),
            "gold_metrics": metrics_from_facts(facts),
            "gold_status": status_from_facts(facts),
        }
    )


@query("mart_grain_counts")
def mart_grain_counts(spark, sf_dir):
    return reports.grain_counts(_reporting(spark, sf_dir)[MART], "window_start", "currency")


# -- reports ------------------------------------------------------------------------------


@query("latest_silver")
def latest_silver(spark, sf_dir):
    return reports.latest_events(to_silver(_bronze(spark, sf_dir)))


@query("latest_metrics")
def latest_metrics(spark, sf_dir):
    return reports.latest_metrics(order_metrics(_events(spark, sf_dir)))


@query("latest_status")
def latest_status(spark, sf_dir):
    return reports.latest_status(status_distribution(_events(spark, sf_dir)))


@query("recent_metrics")
def recent_metrics(spark, sf_dir):
    return reports.recent_metrics(_metrics_table(_facts(spark, sf_dir)))


@query("preview_bronze")
def preview_bronze(spark, sf_dir):
    return reports.preview_bronze(_bronze(spark, sf_dir))


@query("preview_quarantine")
def preview_quarantine(spark, sf_dir):
    preview = reports.preview_quarantine(to_quarantine(_bronze(spark, sf_dir)))
    return preview.withColumn("validation_errors", F.array_join("validation_errors", ","))


# -- deduplication and streams ------------------------------------------------------------


@query("dedup_batch")
def dedup_batch(spark, sf_dir):
    twice = testbed.redeliver(_events(spark, sf_dir))
    return dedup_events(twice, "7 days").select("event_id", "event_time", *POSITION_COLUMNS)


@query("dedup_within_watermark")
def dedup_within_watermark(spark, sf_dir):
    config = _config(spark, "dedup")
    events = testbed.order_events(testbed.stream_events(spark, sf_dir))
    single = dedup_events(testbed.redeliver(events), config.silver_delay).select(
        "event_id", "order_id", "event_time", F.to_date("event_time").alias("event_date")
    )
    finish(
        start_files(
            single,
            config,
            name="dedup",
            path=config.silver,
            partition_column="event_date",
            bounded=True,
        )
    )
    return scan(spark, config.silver, single.schema)


@query("stream_several_files")
def stream_several_files(spark, sf_dir):
    """Thirty files, ten to a micro-batch; the copies of events come in later ones."""
    config = LakeConfig(root=scratch_path(spark, "several_files"))
    events = testbed.redeliver(_events(spark, sf_dir))
    first = F.col("kafka_offset") < testbed.REDELIVERY_SHIFT
    for sent, number in ((first, F.col("n")), (~first, F.col("n") / testbed.REDELIVERY_CYCLE)):
        dealt = events.filter(sent).withColumn("file", (number % 15).cast("int"))
        dealt.repartition("file").write.mode("append").partitionBy("file").parquet(config.bronze)
    schema = events.withColumn("file", F.lit(0)).schema
    stream = stream_parquet(spark, config.bronze, schema, config.max_files_per_trigger)
    single = dedup_events(stream, "60 days").withColumn("event_date", F.to_date("event_time"))
    query = start_files(
        single, config, name="several", path=config.silver, partition_column="event_date", bounded=True
    )
    finish(query)
    batches = sum(p.numInputRows > 0 for p in query.recentProgress)
    return scan(spark, config.silver, single.schema).select(
        "event_id", "event_time", F.lit(batches).alias("micro_batches")
    )


def _stream_gold(spark, sf_dir, name, build, columns):
    config = _config(spark, name)
    events = testbed.order_events(testbed.stream_events(spark, sf_dir))
    final = build(events, config.gold_delay, config.window)
    finish(
        start_files(
            final,
            config,
            name=name,
            path=config.gold_metrics,
            partition_column="window_date",
            bounded=True,
        )
    )
    return scan(spark, config.gold_metrics, final.schema).select(columns)


@query("stream_gold_order_metrics")
def stream_gold_order_metrics(spark, sf_dir):
    return _stream_gold(spark, sf_dir, "gold_metrics", order_metrics, METRIC_COLUMNS)


@query("stream_gold_status")
def stream_gold_status(spark, sf_dir):
    return _stream_gold(spark, sf_dir, "gold_status", status_distribution, STATUS_COLUMNS)


def _window_counts_over_arrivals(spark, sf_dir, name, delays):
    """Hourly counts of a stream that is stopped and resumed between arrivals.

    Each delay sends all events once more, that much later in event time; None
    resumes the stream with nothing new.
    """
    config = _config(spark, name)
    events = _events(spark, sf_dir).select(
        "event_id", "event_type", "order_amount", "currency", "event_time"
    )
    for delay in delays:
        if delay is not None:
            moved = F.col("event_time") + F.expr(f"INTERVAL {delay}")
            events.withColumn("event_time", moved).write.mode("append").parquet(config.silver)
        arriving = stream_parquet(spark, config.silver, events.schema, None)
        final = order_metrics(arriving, config.gold_delay, config.window)
        finish(
            start_files(
                final,
                config,
                name=name,
                path=config.gold_metrics,
                partition_column="window_date",
                bounded=True,
            )
        )
    return scan(spark, config.gold_metrics, GOLD_METRICS).select(
        "window_start", "currency", "order_event_count", "revenue"
    )


@query("late_rows")
def late_rows(spark, sf_dir):
    """All events again, 12 hours on: most come too late for their window."""
    return _window_counts_over_arrivals(
        spark, sf_dir, "late_rows", ["0 HOURS", "12 HOURS"]
    )


@query("checkpoint_resume")
def checkpoint_resume(spark, sf_dir):
    """A resumed stream emits the windows left open, and none a second time."""
    return _window_counts_over_arrivals(
        spark, sf_dir, "resume", ["0 HOURS", None, "60 DAYS", None]
    )


@query("stream_silver_split")
def stream_silver_split(spark, sf_dir):
    config = _config(spark, "silver_split")
    finish(start_bronze(_message_stream(spark, sf_dir), config, bounded=True))
    finish(*start_silver(spark, config, bounded=True))
    silver = scan_parts(spark, config.silver, SILVER).select(
        F.lit("silver").alias("branch"),
        F.col("event_id").alias("ident"),
        F.lit("").alias("validation_errors"),
    )
    quarantine = scan_parts(spark, config.quarantine, QUARANTINE).select(
        F.lit("quarantine").alias("branch"),
        F.concat_ws(":", "kafka_partition", "kafka_offset").alias("ident"),
        F.array_join("validation_errors", ",").alias("validation_errors"),
    )
    return silver.unionByName(quarantine)


# -- data quality ---------------------------------------------------------------------------


def _both(build: Callable[[dict[str, DataFrame]], DataFrame], clean, faulty) -> DataFrame:
    """The same check on clean and on broken tables, told apart by ``variant``."""
    return reduce(
        DataFrame.unionByName,
        [
            build(frames).withColumn("variant", F.lit(name))
            for name, frames in (("clean", clean), ("faulty", faulty))
        ],
    )


def _broken(df: DataFrame, where: str, name: str, value: str) -> DataFrame:
    kind = df.schema[name].dataType
    changed = F.when(F.expr(where), F.expr(value).cast(kind)).otherwise(F.col(name))
    return df.withColumn(name, changed)


def _faulty(spark: SparkSession, clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every kind of data fault at once, each in one currency or status.

    The mart is built from sound tables and then broken by itself, so that a
    fault shows up in one test only.
    """
    metrics, status, mart = clean[METRICS], clean[STATUS], clean[MART]
    metrics = _broken(metrics, "currency = 'EUR'", "revenue", "NULL")
    metrics = _broken(metrics, "currency = 'USD'", "window_end", "window_start")
    metrics = _broken(metrics, "currency = 'EUR'", "loaded_at", "NULL")
    metrics = metrics.unionByName(metrics.filter("currency = 'TWD'"))
    status = _broken(status, "order_status = 'paid' AND currency = 'EUR'", "order_status", "'shipped'")
    status = status.unionByName(status.filter("order_status = 'cancelled'"))
    mart = _broken(mart, "currency = 'EUR'", "revenue", "-1")
    mart = _broken(mart, "currency = 'USD'", "paid_event_count", "paid_event_count + 1")
    mart = mart.unionByName(mart.filter("currency = 'TWD'"))
    return {
        METRICS: metrics,
        STATUS: status,
        "stg_order_metrics_hourly": stage_metrics(metrics),
        "stg_order_status_hourly": stage_status(status),
        MART: mart,
    }


def _checked(spark, sf_dir, build):
    clean = _reporting(spark, sf_dir)
    return _both(build, clean, _faulty(spark, clean))


@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    return _checked(spark, sf_dir, quality.not_null)


@query("dq_accepted_values")
def dq_accepted_values(spark, sf_dir):
    return _checked(
        spark, sf_dir, lambda f: quality.unknown_statuses(f[STATUS]).select(STATUS_COLUMNS)
    )


@query("grain_violations")
def grain_violations(spark, sf_dir):
    return _checked(
        spark, sf_dir, lambda f: quality.repeated_source_grains(f[METRICS], f[STATUS])
    )


@query("dq_unique_grain")
def dq_unique_grain(spark, sf_dir):
    return _checked(spark, sf_dir, lambda f: quality.repeated_mart_grains(f[MART]))


@query("dq_non_negative")
def dq_non_negative(spark, sf_dir):
    return _checked(spark, sf_dir, lambda f: quality.negative_measures(f[MART]))


@query("dq_reconcile")
def dq_reconcile(spark, sf_dir):
    return _checked(spark, sf_dir, lambda f: quality.unreconciled(f[MART]))


@query("dq_constraints")
def dq_constraints(spark, sf_dir):
    def violations(frames):
        parts = (
            (METRICS, quality.metrics_constraints(), METRICS_KEY),
            (STATUS, quality.status_constraints(), STATUS_KEY),
            (STORE, quality.store_constraints(), ["event_id"]),
        )
        return reduce(
            DataFrame.unionByName,
            [
                quality.constraint_violations(frames[name], checks, key).withColumn(
                    "dataset", F.lit(name)
                )
                for name, checks, key in parts
            ],
        )

    clean = _reporting(spark, sf_dir)
    store = store_rows(_events(spark, sf_dir))
    faulty = _faulty(spark, clean)
    unpaid = _broken(store, "order_status = 'paid'", "raw_event", "NULL")
    faulty[STORE] = unpaid.unionByName(store.filter("order_status = 'pending'"))
    return _both(violations, {**clean, STORE: store}, faulty).filter("failing_rows > 0")


@query("dq_suite")
def dq_suite(spark, sf_dir):
    return _checked(spark, sf_dir, quality.run_suite)


# -- pipelines --------------------------------------------------------------------------------


@query("refresh_marts")
def refresh_marts_twice(spark, sf_dir):
    """Load, build, test and publish; then once more, which must not matter."""
    config = _config(spark, "refresh")
    build_gold(spark, config, _events(spark, sf_dir))
    refresh_marts(spark, config)
    return refresh_marts(spark, config)


@query("lake_end_to_end")
def lake_end_to_end(spark, sf_dir):
    """Messages through all streaming hops, then the reporting refresh."""
    config = _config(spark, "lake")
    run_lake(spark, config, _message_stream(spark, sf_dir), bounded=True)
    return refresh_marts(spark, config)


@query("lake_batch")
def lake_batch(spark, sf_dir):
    """The flagship: messages to bronze, silver, quarantine and gold in batch."""
    config = _config(spark, "lake_batch")
    build_lake(spark, config, _messages(spark, sf_dir))
    return scan(spark, config.batch_part(config.gold_metrics), GOLD_METRICS)


@query("lake_backfill_then_stream")
def lake_backfill_then_stream(spark, sf_dir):
    """Two transport partitions in batch, then two as streams, one of them again.

    Silver holds each event once, and the hourly counts are those of all of them.
    """
    config = _config(spark, "backfill")
    build_lake(spark, config, _of_partitions(_messages(spark, sf_dir), 0, 1))
    run_lake(spark, config, _of_partitions(_message_stream(spark, sf_dir), 1, 2), bounded=True)
    silver = scan_parts(spark, config.silver, SILVER)
    gold = scan_final(spark, config.gold_metrics, GOLD_METRICS, METRICS_KEY)
    events = silver.select(
        F.lit("silver").alias("dataset"), "event_id", "event_time", "currency", "order_amount"
    )
    counts = gold.select(
        F.lit("gold").alias("dataset"),
        F.lit(None).cast("string").alias("event_id"),
        F.col("window_start").alias("event_time"),
        "currency",
        F.col("order_event_count").cast("decimal(12,2)").alias("order_amount"),
    )
    return events.unionByName(counts)

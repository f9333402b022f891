"""Streams: late rows, resuming, batch equivalence, failing stores, bounded runs."""

import json
import os
import shutil
import threading
import time
from datetime import datetime
from pathlib import Path

import pytest
from builders import ENVELOPE, EVENT_ID, event, messages
from pyspark.sql import functions as F

from orderlake.config import LakeConfig
from orderlake.functions.strict import accepted, apply_contract
from orderlake.operators.bronze import envelope, to_bronze
from orderlake.operators.dedup import dedup_events
from orderlake.operators.gold import order_metrics, status_distribution
from orderlake.operators.silver import to_silver
from orderlake.plans import testbed
from orderlake.plans.lake import build_lake, run_lake
from orderlake.plans.refresh import METRICS, load_reporting_tables, read_mart, refresh_marts
from orderlake.operators.quality import ConstraintError, QualityError
from orderlake.schemas import BRONZE, GOLD_METRICS, GOLD_STATUS, METRICS_TABLE, QUARANTINE, SILVER, STATUS_KEY
from orderlake.sources import event_store
from orderlake.sources.event_store import read_store
from orderlake.sources.published import read_published
from orderlake.sources.readers import scan, scan_final, scan_parts
from orderlake.streaming import lake
from orderlake.streaming.runner import finish, start_files, wait_for_any

SMOKE = "/root/testdata/sf0.001"

#: Files of (key, time) that arrive one after the other.
ARRIVALS = [
    [("a", "2026-08-01 00:10"), ("b", "2026-08-05 00:00")],
    [("a", "2026-08-01 00:30"), ("e", "2026-08-07 05:00")],
    [("a", "2026-08-01 00:40"), ("f", "2026-08-03 00:10"), ("g", "2026-08-05 03:00"), ("b", "2026-08-08 00:00")],
    [("q", "2026-08-20 00:00")],
]


@pytest.fixture
def config(tmp_path):
    return LakeConfig(root=str(tmp_path / "lake"), max_files_per_trigger=None, state_partitions=4)


def arrivals(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, rows in enumerate(ARRIVALS):
        file = source / f"f{i}.json"
        file.write_text("\n".join(json.dumps({"event_id": k, "event_time": t + ":00"}) for k, t in rows))
        os.utime(file, (1_750_000_000 + 10 * i,) * 2)
    return (
        spark.readStream.schema("event_id string, event_time timestamp")
        .option("maxFilesPerTrigger", 1)
        .json(str(source))
    )


def test_late_rows_of_deduplication(spark, tmp_path, config):
    df = dedup_events(arrivals(spark, tmp_path), "1 day").withColumn("d", F.to_date("event_time"))
    finish(start_files(df, config, name="dedup", path=config.silver, partition_column="d", bounded=True))
    got = scan(spark, config.silver, df.schema).select("event_id", F.date_format("event_time", "MM-dd HH:mm"))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", "08-01 00:10"),
        ("b", "08-05 00:00"),
        ("e", "08-07 05:00"),
        ("g", "08-05 03:00"),
        ("q", "08-20 00:00"),
    ]


def test_late_rows_of_windows(spark, tmp_path, config):
    df = arrivals(spark, tmp_path).withColumns({"currency": F.lit("USD"), "order_status": F.lit("paid")})
    final = status_distribution(df, "1 day", "1 hour")
    finish(start_files(final, config, name="w", path=config.gold_status, partition_column="window_date", bounded=True))
    got = scan(spark, config.gold_status, GOLD_STATUS).select(
        F.date_format("window_start", "MM-dd HH"), "status_event_count"
    )
    assert sorted(tuple(r) for r in got.collect()) == [
        ("08-01 00", 2), ("08-05 00", 1), ("08-05 03", 1), ("08-07 05", 1), ("08-08 00", 1),
    ]


def test_final_windows_equal_the_batch_result(spark, config):
    raw = testbed.read_table(spark, SMOKE, "events")
    batch = order_metrics(testbed.order_events(raw))
    last = raw.agg(F.max("ts").cast("timestamp").alias("t")).first().t
    stream = order_metrics(testbed.order_events(testbed.stream_events(spark, SMOKE)), "1 day")
    finish(start_files(stream, config, name="m", path=config.gold_metrics, partition_column="window_date", bounded=True))
    names = [n for n in GOLD_METRICS.fieldNames() if n != "aggregated_at"]
    closed = batch.filter(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 1 DAY"))
    got = scan(spark, config.gold_metrics, GOLD_METRICS).select(names)
    assert got.count() > 0
    assert got.exceptAll(closed.select(names)).isEmpty()
    assert closed.select(names).exceptAll(got).isEmpty()


def stream_of(spark, tmp_path, values):
    path = str(tmp_path / "topic")
    messages(spark, values).coalesce(1).write.parquet(path)
    return spark.readStream.schema(ENVELOPE).parquet(path)


@pytest.mark.parametrize("ids_in_state", [False, True])
def test_poison_does_not_block(spark, tmp_path, config, ids_in_state):
    topic = stream_of(spark, tmp_path, [None, "this-is-not-json", event(), event()])
    finish(lake.start_event_store(topic, config, True, ids_in_state=ids_in_state))
    assert [r.event_id for r in read_store(spark, config.event_store).collect()] == [EVENT_ID]


def test_failed_store_commits_nothing(spark, tmp_path, config, monkeypatch):
    topic = stream_of(spark, tmp_path, [event()])

    def broken(*args, **kwargs):
        raise RuntimeError("store is down")

    monkeypatch.setattr(lake, "insert_if_absent", broken)
    with pytest.raises(Exception, match="store is down"):
        finish(lake.start_event_store(topic, config, True))
    commits = Path(config.checkpoint("event_store")) / "commits"
    assert [p.name for p in commits.glob("[0-9]*")] == []
    monkeypatch.undo()
    finish(lake.start_event_store(topic, config, True))
    assert read_store(spark, config.event_store).count() == 1


def test_batch_repeated_after_a_crash_is_stored_once(spark, tmp_path, config, monkeypatch):
    topic = stream_of(spark, tmp_path, [event(), event(event_id=EVENT_ID[:-1] + "0")])
    real = event_store.insert_if_absent

    def crash_after_write(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("crashed before commit")

    monkeypatch.setattr(lake, "insert_if_absent", crash_after_write)
    with pytest.raises(Exception, match="crashed before commit"):
        finish(lake.start_event_store(topic, config, True))
    monkeypatch.undo()
    finish(lake.start_event_store(topic, config, True))
    assert read_store(spark, config.event_store).count() == 2


def test_state_partitions_apply_to_the_stream_only(spark, config):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream = to_bronze(testbed.messages(testbed.stream_events(spark, SMOKE)))
    df = to_silver(stream, "7 days")
    finish(start_files(df, config, name="s", path=config.silver, partition_column="event_date", bounded=True))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = Path(config.checkpoint("s")) / "state" / "0"
    assert len([p for p in state.iterdir() if p.name.isdigit()]) == 4


def test_bounded_lake_equals_the_batch_lake(spark, tmp_path, config):
    run_lake(spark, config, testbed.messages(testbed.stream_events(spark, SMOKE)), bounded=True)
    other = LakeConfig(root=str(tmp_path / "batch"))
    build_lake(spark, other, testbed.messages(testbed.read_table(spark, SMOKE, "events")))
    for path, schema, names in [
        ("silver", SILVER, ["event_id", "order_amount", "event_date"]),
        ("quarantine", QUARANTINE, ["raw_event", "validation_errors", "kafka_offset"]),
    ]:
        streamed = scan_parts(spark, getattr(config, path), schema).select(names)
        built = scan_parts(spark, getattr(other, path), schema).select(names)
        assert streamed.count() == built.count() > 0
        assert streamed.exceptAll(built).isEmpty()


def test_refresh_is_repeatable_and_stops_on_faults(spark, tmp_path):
    config = LakeConfig(root=str(tmp_path / "lake"))
    build_lake(spark, config, testbed.messages(testbed.read_table(spark, SMOKE, "events")))
    mart = refresh_marts(spark, config)
    names = [n for n in mart.columns if n != "loaded_at"]
    first = {tuple(r) for r in mart.select(names).collect()}
    again = refresh_marts(spark, config)
    assert {tuple(r) for r in again.select(names).collect()} == first

    # Status counts that do not add up: the tables load, the mart stays.
    built = config.batch_part
    gold = scan(spark, built(config.gold_status), GOLD_STATUS)
    gold.withColumns(
        {
            "status_event_count": F.col("status_event_count") + 1,
            "aggregated_at": F.col("aggregated_at") + F.expr("INTERVAL 1 DAY"),
        }
    ).write.mode("append").partitionBy("window_date").parquet(built(config.gold_status))
    with pytest.raises(QualityError, match="status_counts_reconcile"):
        refresh_marts(spark, config)
    kept = read_mart(spark, config, mart.schema)
    assert {tuple(r) for r in kept.select(names).collect()} == first

    # A row the table would refuse: neither table moves.
    tables = f"{config.reporting}/tables"
    before = read_published(spark, tables, METRICS, METRICS_TABLE).count()
    bad = scan(spark, built(config.gold_metrics), GOLD_METRICS).limit(1)
    bad.withColumns(
        {"currency": F.lit("XXX"), "window_end": F.col("window_start")}
    ).write.mode("append").partitionBy("window_date").parquet(built(config.gold_metrics))
    with pytest.raises(ConstraintError, match="window_end > window_start"):
        load_reporting_tables(spark, config)
    assert read_published(spark, tables, METRICS, METRICS_TABLE).count() == before


def test_refresh_since_a_date(spark, tmp_path):
    config = LakeConfig(root=str(tmp_path / "lake"))
    build_lake(spark, config, testbed.messages(testbed.read_table(spark, SMOKE, "events")))
    tables = load_reporting_tables(spark, config, since="2024-01-20")
    assert tables[METRICS].agg(F.min("window_start").alias("m")).first().m >= datetime(2024, 1, 20)


def test_all_queries_stop_when_one_ends(spark, tmp_path, config):
    spark.streams.resetTerminated()
    topic = stream_of(spark, tmp_path, [event()])
    endless = lake.start_bronze(topic, config)
    bounded = lake.start_event_store(topic, config, bounded=True)
    wait_for_any(spark, [endless, bounded])
    assert not endless.isActive and not bounded.isActive
    assert [endless.name, bounded.name] == ["bronze_orders", "event_store"]


def test_continuous_lake(spark, tmp_path):
    """All four queries run side by side from nothing, until one is stopped."""
    config = LakeConfig(root=str(tmp_path / "lake"), trigger_interval="1 second", state_partitions=2)
    topic = stream_of(spark, tmp_path, [event(), "this-is-not-json"])
    runner = threading.Thread(target=run_lake, args=(spark, config, topic))
    runner.start()
    try:
        for _ in range(90):
            time.sleep(1)
            silver = scan_parts(spark, config.silver, SILVER).count()
            quarantine = scan_parts(spark, config.quarantine, QUARANTINE).count()
            if silver and quarantine:
                break
        names = {q.name for q in spark.streams.active}
    finally:
        for active in spark.streams.active:
            active.stop()
        runner.join(60)
    assert (silver, quarantine) == (1, 1)
    assert names == {
        "bronze_orders", "silver_orders", "quarantine_orders", "gold_orders"
    }
    assert not runner.is_alive() and not spark.streams.active


@pytest.mark.parametrize("bound", [None, 2])
def test_tasks_that_write_a_date(spark, tmp_path, bound):
    """All state partitions write a date that holds the whole batch, unless bounded."""
    config = LakeConfig(
        root=str(tmp_path / "lake"), state_partitions=8, silver_files_per_date=bound
    )
    raw = testbed.stream_events(spark, SMOKE).withColumn("ts", F.lit("2024-01-05").cast("timestamp"))
    run_lake(spark, config, testbed.messages(raw), bounded=True)
    (date,) = Path(config.stream_part(config.silver)).glob("event_date=*")
    files = len(list(date.glob("*.parquet")))
    assert files == bound if bound else files > 4
    dates = list(Path(config.stream_part(config.gold_metrics)).glob("batch_id=*/window_date=*"))
    assert all(len(list(date.glob("*.parquet"))) == 1 for date in dates)


def test_gold_sets_agree_whenever_a_write_stops(spark, tmp_path, config, monkeypatch):
    """Status counts without metrics do no harm, and the replay completes the pair."""
    run_hops = testbed.messages(testbed.stream_events(spark, SMOKE))
    finish(lake.start_bronze(run_hops, config, bounded=True))
    finish(*lake.start_silver(spark, config, bounded=True))
    real = lake.write_partitioned

    def fail_on_metrics(df, path, *columns, **kwargs):
        if "order_metrics" in path:
            raise RuntimeError("disk is full")
        real(df, path, *columns, **kwargs)

    monkeypatch.setattr(lake, "write_partitioned", fail_on_metrics)
    with pytest.raises(Exception, match="disk is full"):
        finish(*lake.start_gold(spark, config, bounded=True))
    with pytest.raises(FileNotFoundError):
        refresh_marts(spark, config)
    monkeypatch.undo()
    finish(*lake.start_gold(spark, config, bounded=True))
    mart = refresh_marts(spark, config)
    status = scan_final(spark, config.gold_status, GOLD_STATUS, STATUS_KEY)
    assert mart.agg(F.sum("order_event_count")).first()[0] == status.agg(F.sum("status_event_count")).first()[0]


def test_build_beside_streams_is_refused(spark, config):
    messages = testbed.messages(testbed.read_table(spark, SMOKE, "events"))
    build_lake(spark, config, messages)
    build_lake(spark, config, messages)  # a build may follow a build
    run_lake(spark, config, testbed.messages(testbed.stream_events(spark, SMOKE)), bounded=True)
    silver = scan_parts(spark, config.silver, SILVER)
    assert silver.count() == silver.select("event_id").distinct().count()
    bronze = scan_parts(spark, config.bronze, BRONZE).count()
    assert bronze == 2 * messages.count()
    with pytest.raises(ValueError, match="streams have written"):
        build_lake(spark, config, messages)
    assert scan_parts(spark, config.bronze, BRONZE).count() == bronze
    refresh_marts(spark, config)


def test_store_of_a_lost_checkpoint_is_not_overwritten(spark, tmp_path, config):
    topic = stream_of(spark, tmp_path, [event()])
    finish(lake.start_event_store(topic, config, True, ids_in_state=True))
    finish(lake.start_event_store(topic, config, True, ids_in_state=True))
    assert read_store(spark, config.event_store).count() == 1
    shutil.move(config.checkpoint("event_store_state"), str(tmp_path / "elsewhere"))
    with pytest.raises(ValueError, match="checkpoint"):
        lake.start_event_store(topic, config, True, ids_in_state=True)


def test_replayed_micro_batch_replaces_its_folder(spark, tmp_path):
    path, staging = str(tmp_path / "store"), str(tmp_path / "staging")
    events = accepted(apply_contract(envelope(messages(spark, [event(), None]))))
    for _ in range(2):
        assert event_store.append_batch(spark, events, path, staging, 0) == 1
    assert read_store(spark, path).count() == 1
    assert event_store.insert_if_absent(spark, events, path, staging) == 0

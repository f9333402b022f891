"""Readers, sinks, published tables and the event store."""

import pytest
from builders import EVENT_ID, ORDER_ID, event, messages
from pyspark.sql import functions as F

from orderlake.functions.strict import accepted, apply_contract
from orderlake.operators.bronze import envelope
from orderlake.operators.reports import stored_count
from orderlake.plans import testbed
from orderlake.schemas import SILVER
from orderlake.session import scratch_path, session_settings
from orderlake.sources.catalog import register_views, table_row_counts
from orderlake.sources.event_store import batch_ids, id_bucket, insert_if_absent, read_store
from orderlake.sources.published import (
    commit_generation,
    current_generation,
    read_published,
    stage_tables,
)
from orderlake.sources.readers import (
    kafka_source_options,
    scan_if_available,
    scan_pruned,
    stream_parquet,
)
from orderlake.sources.sinks import kafka_sink_options, write_partitioned


def test_kafka_options():
    source = kafka_source_options("b:9092", "t")
    assert source["startingOffsets"] == "earliest" and source["failOnDataLoss"] == "true"
    assert source["subscribe"] == "t" and "maxOffsetsPerTrigger" not in source
    bounded = kafka_source_options("b:9092", "t", 1000, 64)
    assert bounded["maxOffsetsPerTrigger"] == "1000" and bounded["minPartitions"] == "64"
    sink = kafka_sink_options("b:9092", "t")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_stream_reader_options(spark, tmp_path):
    spark.createDataFrame([], SILVER).write.parquet(str(tmp_path / "s"))
    df = stream_parquet(spark, str(tmp_path / "s"), SILVER)
    assert df.isStreaming and df.schema.fieldNames() == SILVER.fieldNames()


def test_scan_if_available(spark, tmp_path):
    assert scan_if_available(spark, str(tmp_path / "missing"), SILVER).count() == 0
    (tmp_path / "empty").mkdir()
    assert scan_if_available(spark, str(tmp_path / "empty"), SILVER).count() == 0
    (tmp_path / "rowless" / "_spark_metadata").mkdir(parents=True)
    assert scan_if_available(spark, str(tmp_path / "rowless"), SILVER).count() == 0
    with pytest.raises(Exception, match="nosuchscheme"):
        scan_if_available(spark, "nosuchscheme:/x", SILVER)


def test_scan_pruned(spark, tmp_path):
    for name in ("missing", "empty"):
        with pytest.raises(FileNotFoundError):
            scan_pruned(spark, str(tmp_path / name), ["a"])
        (tmp_path / "empty").mkdir(exist_ok=True)
    path = str(tmp_path / "d")
    df = spark.range(10).selectExpr("id", "id * 2 AS twice", "date_add(date'2026-08-01', int(id)) AS d")
    write_partitioned(df, path, "d")
    got = scan_pruned(spark, path, ["twice"], partition_column="d", since="2026-08-03", until="2026-08-04")
    assert sorted(r.twice for r in got.collect()) == [4, 6]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint>" in text
    assert "PartitionFilters: [isnotnull(d" in text


def test_session_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_settings(spark, {"spark.sql.shuffle.partitions": "3", "orderlake.x": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("orderlake.x", None) is None


def test_scratch_goes_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first.startswith(shared) and first != second


def test_table_row_counts(spark):
    register_views({"rc_one": spark.range(3), "rc_two": spark.range(5)})
    got = {r.dataset: r.row_count for r in table_row_counts(spark, pattern="rc_*").collect()}
    assert got == {"rc_one": 3, "rc_two": 5}
    assert table_row_counts(spark, pattern="no_such_*").collect() == []


def test_table_row_counts_of_a_named_database(spark):
    spark.sql("CREATE DATABASE rc_named")
    register_views({"rc_view": spark.range(9)})
    assert table_row_counts(spark, "rc_named").collect() == []
    for name, n in (("zz", 2), ("1a", 4)):
        spark.range(n).write.saveAsTable(f"rc_named.`{name}`")
    assert [tuple(r) for r in table_row_counts(spark, "rc_named").collect()] == [("1a", 4), ("zz", 2)]


# -- published tables -----------------------------------------------------------


def numbers(spark, n):
    return spark.range(n).coalesce(1)


def test_tables_appear_together(spark, tmp_path):
    root = str(tmp_path / "pub")
    schema = numbers(spark, 1).schema
    assert current_generation(spark, root) == 0
    assert read_published(spark, root, "a", schema).count() == 0
    generation = current_generation(spark, root) + 1
    stage_tables(spark, root, generation, {"a": numbers(spark, 3), "b": numbers(spark, 4)})
    assert read_published(spark, root, "a", schema).count() == 0
    commit_generation(spark, root, generation)
    assert read_published(spark, root, "a", schema).count() == 3
    assert read_published(spark, root, "b", schema).count() == 4


def test_failed_second_table_leaves_the_old_pair(spark, tmp_path):
    root = str(tmp_path / "pub")
    schema = numbers(spark, 1).schema
    generation = current_generation(spark, root) + 1
    stage_tables(spark, root, generation, {"a": numbers(spark, 1), "b": numbers(spark, 1)})
    commit_generation(spark, root, generation)
    boom = numbers(spark, 1).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        stage_tables(spark, root, 2, {"a": numbers(spark, 2), "b": boom})
    assert read_published(spark, root, "a", schema).count() == 1
    assert read_published(spark, root, "b", schema).count() == 1
    generation = current_generation(spark, root) + 1
    stage_tables(spark, root, generation, {"a": numbers(spark, 2), "b": numbers(spark, 2)})
    commit_generation(spark, root, generation)
    assert read_published(spark, root, "a", schema).count() == 2


def test_reading_while_replacing_and_ring_reuse(spark, tmp_path):
    root = str(tmp_path / "pub")
    schema = numbers(spark, 1).schema
    for n in range(1, 6):
        held = read_published(spark, root, "a", schema)
        generation = current_generation(spark, root) + 1
        stage_tables(spark, root, generation, {"a": held.unionByName(numbers(spark, 1))})
        commit_generation(spark, root, generation)
        assert read_published(spark, root, "a", schema).count() == n
    assert sorted(p.name for p in (tmp_path / "pub").glob("slot*")) == ["slot0", "slot1", "slot2"]


# -- event store ------------------------------------------------------------------


def contract_events(spark, values):
    return accepted(apply_contract(envelope(messages(spark, values))))


def test_insert_if_absent(spark, tmp_path):
    path, staging = str(tmp_path / "store"), str(tmp_path / "staging")
    other = EVENT_ID.replace("3", "4")
    batch = contract_events(spark, [event(), event(order_amount="9.00"), event(event_id=other)])
    assert insert_if_absent(spark, batch, path, staging) == 2
    assert insert_if_absent(spark, batch, path, staging) == 0
    late = contract_events(spark, [event(order_amount="7.00"), None, "this-is-not-json"])
    assert insert_if_absent(spark, late, path, staging) == 0
    stored = read_store(spark, path)
    assert stored.count() == 2
    assert stored_count(stored, EVENT_ID).first().stored_count == 1
    row = stored.filter(F.col("event_id") == EVENT_ID).first()
    assert str(row.order_amount) == "150.00" and '"currency":"USD"' in row.raw_event
    assert row.ingested_at is not None


def test_partly_written_batch_is_completed(spark, tmp_path):
    path, staging = str(tmp_path / "store"), str(tmp_path / "staging")
    raw = testbed.read_table(spark, "/root/testdata/sf0.001", "events")
    events = testbed.order_events(raw).drop("n", "message_key")
    usd = events.filter("currency = 'USD'")
    before = insert_if_absent(spark, usd, path, staging)
    assert insert_if_absent(spark, events, path, staging) == events.count() - before
    assert read_store(spark, path).select("event_id").distinct().count() == events.count()


def test_batch_reads_the_buckets_of_its_ids_only(spark, tmp_path):
    path, staging = str(tmp_path / "store"), str(tmp_path / "staging")
    raw = testbed.read_table(spark, "/root/testdata/sf0.001", "events")
    insert_if_absent(spark, testbed.order_events(raw).drop("n", "message_key"), path, staging)
    rows = spark.createDataFrame([(EVENT_ID,)], "event_id string")
    (bucket,) = rows.select(id_bucket()).first()
    plan = batch_ids(spark, path, rows)._jdf.queryExecution().executedPlan().toString()
    assert f"(id_bucket#" in plan and f" = {bucket})" in plan.split("PartitionFilters:")[1]
    assert "ReadSchema: struct<event_id:string>" in plan
    held = batch_ids(spark, path, rows)
    assert {r[0] for r in held.select(id_bucket()).distinct().collect()} == {bucket}
    assert 0 < held.count() < read_store(spark, path).count() / 4


def test_store_date_filter_prunes_folders(spark, tmp_path):
    path, staging = str(tmp_path / "store"), str(tmp_path / "staging")
    insert_if_absent(spark, contract_events(spark, [event()]), path, staging)
    df = read_store(spark, path).filter("event_date = date'2026-08-01'").filter(
        F.col("order_id") == ORDER_ID
    )
    assert df.count() == 1
    assert "PartitionFilters: [isnotnull(event_date" in df._jdf.queryExecution().executedPlan().toString()

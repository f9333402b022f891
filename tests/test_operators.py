"""Gold, dedup, lifecycle, upsert, mart and reports on small frames."""

import contextlib
import io
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from builders import bronze, event
from pyspark.sql import functions as F

from orderlake.functions.contract import STATUS_EVENT_TYPE, event_type_of
from orderlake.functions.times import to_utc
from orderlake.functions.wire import to_messages
from orderlake.operators import reports
from orderlake.operators.dedup import dedup_events, keep_first
from orderlake.operators.gold import (
    hourly_facts,
    metrics_from_facts,
    order_metrics,
    status_distribution,
    status_from_facts,
)
from orderlake.operators.lifecycle import expand_lifecycle
from orderlake.operators.mart import hourly_mart
from orderlake.operators.silver import to_silver
from orderlake.operators.upsert import upsert_metrics, upsert_status
from orderlake.plans import testbed
from orderlake.schemas import METRICS_TABLE, STATUS_TABLE, conform

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return testbed.order_events(testbed.read_table(spark, SMOKE, "events")).cache()


def rows(df, *names):
    return sorted(tuple(str(r[n]) for n in names) for r in df.collect())


def plan(df, mode="formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_event_type_of_each_status(spark):
    df = spark.createDataFrame([(s,) for s in [*STATUS_EVENT_TYPE, "shipped"]], "s string")
    got = {r.s: r.t for r in df.select("s", event_type_of(F.col("s")).alias("t")).collect()}
    assert got == {**STATUS_EVENT_TYPE, "shipped": None}


def test_facts_give_the_same_gold(events):
    facts = hourly_facts(events)
    names = [c for c in order_metrics(events).columns if c != "aggregated_at"]
    assert rows(metrics_from_facts(facts), *names) == rows(order_metrics(events), *names)
    names = [c for c in status_distribution(events).columns if c != "aggregated_at"]
    assert rows(status_from_facts(facts), *names) == rows(status_distribution(events), *names)


def test_gold_types(events):
    kinds = dict(order_metrics(events).dtypes)
    assert kinds["revenue"] == "decimal(22,2)"
    assert kinds["average_order_value"] == "decimal(16,6)"
    assert dict(metrics_from_facts(hourly_facts(events)).dtypes) == kinds


def test_average_is_null_and_revenue_zero_without_completed_orders(spark):
    df = to_silver(bronze(spark, [event()]))
    row = order_metrics(df).first()
    assert row.revenue == Decimal("0.00") and row.average_order_value is None
    assert (row.order_event_count, row.created_order_count, row.completed_order_count) == (1, 1, 0)


def test_average_rounds_half_up(spark):
    completed = dict(event_type="order_completed", order_status="completed")
    ids = [f"3f2b8c1a-0d4e-4f6a-9b7c-1e2d3c4b5a6{i}" for i in range(3)]
    values = [
        event(event_id=i, order_amount=a, **completed)
        for i, a in zip(ids, ["0.01", "0.01", "0.03"], strict=True)
    ]
    silver = to_silver(bronze(spark, values))
    assert order_metrics(silver).first().average_order_value == Decimal("0.016667")
    assert metrics_from_facts(hourly_facts(silver)).first().average_order_value == Decimal("0.016667")


def test_batch_dedup_keeps_the_first_delivery(spark):
    df = to_silver(bronze(spark, [event(), event(order_amount="9.00"), event()]))
    kept = df.collect()
    assert [(r.kafka_offset, r.order_amount) for r in kept] == [(0, Decimal("150.00"))]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") >= 0, "hot").alias("k"), "id")
    kept = keep_first(df, ["k"], [F.col("id")])
    text = plan(kept, "simple")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert kept.first().id == 0


def test_dedup_with_a_third_of_all_rows_under_one_id(spark, events):
    """Against brute force in plain Python, copies told apart by their offset."""
    hot = events.withColumn("event_id", F.lit("hot")).withColumn(
        "kafka_offset", F.col("kafka_offset") + 7
    )
    mixed = events.unionByName(testbed.redeliver(events)).unionByName(hot).repartition(16)
    expected = {}
    for r in mixed.select("event_id", "kafka_timestamp", "kafka_partition", "kafka_offset").collect():
        place = (r.kafka_timestamp, r.kafka_partition, r.kafka_offset)
        expected[r.event_id] = min(expected.get(r.event_id, place), place)
    got = {
        r.event_id: (r.kafka_timestamp, r.kafka_partition, r.kafka_offset)
        for r in dedup_events(mixed, "7 days").collect()
    }
    assert got == expected and len(got) == events.count() + 1


def test_filter_does_not_repeat_the_parse(spark):
    text = plan(to_silver(bronze(spark, [event()])), "simple")
    assert text.count("from_json(") == 1


def test_validity_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, [event()]).write.parquet(path)
    df = to_silver(spark.read.parquet(path))
    text = plan(df)
    assert "In(order_status" in text and "GreaterThan(order_amount" in text
    assert "raw_event" not in text


def test_batch_dedup_removes_redeliveries(events):
    assert dedup_events(testbed.redeliver(events), "7 days").count() == events.count()


@pytest.mark.parametrize(
    "cancelled,statuses",
    [(False, ["pending", "paid", "processing", "completed"]), (True, ["pending", "cancelled"])],
)
def test_lifecycle(spark, cancelled, statuses):
    start = datetime(2026, 8, 1, 10)
    df = spark.createDataFrame(
        [("o", "c", Decimal("5.00"), cancelled, start)],
        "order_id string, customer_id string, order_amount decimal(12,2), is_cancelled boolean, started_at timestamp",
    )
    got = expand_lifecycle(df).orderBy("step").collect()
    assert [r.order_status for r in got] == statuses
    assert [r.event_type for r in got] == [STATUS_EVENT_TYPE[s] for s in statuses]
    assert [r.event_time for r in got] == [start + timedelta(minutes=5 * i) for i in range(len(statuses))]
    assert {(r.order_id, r.customer_id, r.order_amount) for r in got} == {("o", "c", Decimal("5.00"))}
    assert {r.key for r in to_messages(
        expand_lifecycle(df).withColumns(
            {"event_id": F.uuid(), "event_version": F.lit(1), "currency": F.lit("USD")}
        )
    ).collect()} == {"o"}


def test_to_utc(spark):
    df = spark.sql(
        "select timestamp_ntz'2026-08-01 10:00:00' a, timestamp_ntz'2026-08-01 10:00:00' b,"
        " timestamp'2026-08-01 10:00:00+08:00' c, 1 d"
    )
    out = to_utc(to_utc(df, "a", "c"), "b", source_zone="America/New_York")
    got = out.select(*[F.col(c).cast("string") for c in "abc"]).first()
    assert tuple(got) == ("2026-08-01 10:00:00", "2026-08-01 14:00:00", "2026-08-01 02:00:00")
    with pytest.raises(TypeError):
        to_utc(df, "d")


def test_to_utc_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2026-08-01 10:00:00' a")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert to_utc(df, "a").select(F.unix_timestamp("a").alias("s")).first().s == 1785578400
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _metrics(spark, *items):
    start = datetime(2026, 8, 1)
    made = [
        (start, start + timedelta(hours=1), currency, n, 0, 0, Decimal("1.00"), None,
         start + timedelta(days=age))
        for currency, n, age in items
    ]
    schema = (
        "window_start timestamp, window_end timestamp, currency string, order_event_count long,"
        " created_order_count long, completed_order_count long, revenue decimal(22,2),"
        " average_order_value decimal(16,6), aggregated_at timestamp"
    )
    return spark.createDataFrame(made, schema)


def test_upsert_metrics(spark):
    old = datetime(2000, 1, 1)
    target = conform(
        _metrics(spark, ("USD", 1, 0), ("EUR", 2, 0)).withColumn("loaded_at", F.lit(old)),
        METRICS_TABLE,
    )
    source = _metrics(spark, ("EUR", 5, 2), ("EUR", 4, 1), ("TWD", 6, 0))
    got = {r.currency: r for r in upsert_metrics(target, source).collect()}
    assert {c: r.order_event_count for c, r in got.items()} == {"USD": 1, "EUR": 5, "TWD": 6}
    assert got["USD"].loaded_at == old
    assert got["EUR"].loaded_at > old and got["TWD"].loaded_at > old


def test_upsert_again_changes_nothing(spark):
    source = _metrics(spark, ("EUR", 5, 2), ("TWD", 6, 0))
    empty = spark.createDataFrame([], METRICS_TABLE)
    once = upsert_metrics(empty, source)
    names = [c for c in METRICS_TABLE.fieldNames() if c != "loaded_at"]
    assert rows(upsert_metrics(once, source), *names) == rows(once, *names)


def test_upsert_status_key_has_the_status(spark):
    start = datetime(2026, 8, 1)
    schema = "window_start timestamp, window_end timestamp, currency string, order_status string, status_event_count long, aggregated_at timestamp"

    def frame(*items):
        return spark.createDataFrame(
            [(start, start, "USD", status, n, start) for status, n in items], schema
        )

    target = conform(frame(("paid", 1), ("pending", 1)), STATUS_TABLE)
    got = upsert_status(target, frame(("paid", 7), ("completed", 3)))
    assert rows(got, "order_status", "status_event_count") == [
        ("completed", "3"), ("paid", "7"), ("pending", "1"),
    ]


def test_mart_fills_missing_counts(spark):
    metrics = conform(_metrics(spark, ("USD", 3, 0)), METRICS_TABLE)
    row = hourly_mart(metrics, spark.createDataFrame([], STATUS_TABLE)).first()
    assert row.paid_event_count == 0 and row.completed_status_event_count == 0


def test_reports(spark, events):
    assert reports.latest_events(events.withColumn("event_date", F.to_date("event_time"))).count() == 20
    twice = events.unionByName(events.filter("currency = 'USD'"))
    usd = events.filter("currency = 'USD'").count()
    assert reports.duplicate_key_count(twice, "event_id").first().duplicate_count == usd
    one = events.first().event_id
    assert reports.stored_count(events, one).first().stored_count == 1


def test_top_n_does_not_sort_everything(events):
    text = plan(reports.latest_events(events.withColumn("event_date", F.to_date("event_time"))))
    assert "TakeOrderedAndProject" in text

"""Data-quality checks: silent on sound tables, loud on each kind of fault."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.operators import quality
from orderlake.operators.gold import hourly_facts, metrics_from_facts, status_from_facts
from orderlake.plans import testbed
from orderlake.plans.refresh import MART, METRICS, STATUS, reporting_frames
from orderlake.schemas import METRICS_KEY, METRICS_TABLE, STATUS_TABLE, conform


@pytest.fixture(scope="module")
def frames(spark):
    raw = testbed.read_table(spark, "/root/testdata/sf0.001", "events")
    facts = hourly_facts(testbed.order_events(raw)).cache()
    return reporting_frames(
        conform(metrics_from_facts(facts), METRICS_TABLE).cache(),
        conform(status_from_facts(facts), STATUS_TABLE).cache(),
    )


def change(df, name, value):
    kind = df.schema[name].dataType
    hit = F.col("currency") == "EUR"
    return df.withColumn(name, F.when(hit, F.lit(value).cast(kind)).otherwise(F.col(name)))


def failing(frames):
    suite = quality.run_suite(frames).collect()
    assert len(suite) == 24
    assert all(r.passed == (r.failing_rows == 0) for r in suite)
    return {r.test_name for r in suite if not r.passed}


def test_clean_suite_passes(frames):
    assert failing(frames) == set()
    quality.require_passing(quality.run_suite(frames))


FAULTS = [
    (METRICS, lambda df: change(df, "revenue", None), {"not_null_order_metrics_hourly_revenue"}),
    (MART, lambda df: change(df, "window_end", None),
     {"not_null_fct_hourly_commerce_metrics_window_end"}),
    (STATUS, lambda df: change(df, "order_status", "shipped"),
     {"accepted_values_order_status_hourly_order_status", "source_grains_are_unique"}),
    (METRICS, lambda df: df.unionByName(df), {"source_grains_are_unique"}),
    (STATUS, lambda df: df.unionByName(df), {"source_grains_are_unique"}),
    (MART, lambda df: df.unionByName(df), {"mart_grain_is_unique"}),
    (MART, lambda df: change(df, "revenue", Decimal("-1")), {"metrics_are_non_negative"}),
    (MART, lambda df: df.withColumn("paid_event_count", F.col("paid_event_count") + 1),
     {"status_counts_reconcile"}),
]


@pytest.mark.parametrize("index", range(len(FAULTS)))
def test_each_fault_is_found(frames, index):
    name, spoil, expected = FAULTS[index]
    broken = {**frames, name: spoil(frames[name])}
    assert failing(broken) == expected
    with pytest.raises(quality.QualityError):
        quality.require_passing(quality.run_suite(broken))


def test_constraints(frames):
    metrics = frames[METRICS]
    checks = quality.metrics_constraints()
    quality.enforce({METRICS: (metrics, checks, METRICS_KEY)})
    for spoiled, text in [
        (metrics.withColumn("window_end", F.col("window_start")), "window_end > window_start"),
        (change(metrics, "created_order_count", -1), "created_order_count >= 0"),
        (change(metrics, "currency", "EURO"), "currency length"),
        (metrics.unionByName(metrics), "unique window_start,currency"),
    ]:
        with pytest.raises(quality.ConstraintError, match=text):
            quality.enforce({METRICS: (spoiled, checks, METRICS_KEY)})


def test_store_constraints(spark):
    row = {n: None for n in quality.store_constraints()}
    assert "raw_event not null" in row
    df = spark.createDataFrame(
        [(None, "x", 1, "o", "c", "paid", Decimal("1"), datetime(2026, 1, 1), datetime(2026, 1, 1), "{}")],
        "event_id string, event_type string, event_version int, order_id string, customer_id string,"
        " order_status string, order_amount decimal(12,2), event_time timestamp,"
        " ingested_at timestamp, raw_event string",
    )
    found = quality.constraint_violations(df, quality.store_constraints(), ["event_id"])
    assert [r.constraint_name for r in found.filter("failing_rows > 0").collect()] == ["event_id not null"]

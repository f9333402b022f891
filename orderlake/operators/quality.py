"""Data-quality checks: each returns the rows, or counts them, that fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.contract import ORDER_STATUSES
from orderlake.operators.mart import MART_KEY, STATUS_COUNT_COLUMN
from orderlake.schemas import METRICS_KEY, STATUS_KEY

# Which columns of which dataset must never be null, and which measures of
# the mart must never be negative.
NOT_NULL_COLUMNS = {
    "order_metrics_hourly": [
        "window_start",
        "window_end",
        "currency",
        "order_event_count",
        "revenue",
    ],
    "order_status_hourly": [
        "window_start",
        "currency",
        "order_status",
        "status_event_count",
    ],
    "stg_order_metrics_hourly": ["window_start", "currency"],
    "stg_order_status_hourly": ["window_start", "currency", "order_status"],
    "fct_hourly_commerce_metrics": [
        "window_start",
        "window_end",
        "currency",
        "order_event_count",
        "revenue",
    ],
}
NON_NEGATIVE_COLUMNS = [
    "order_event_count",
    "created_order_count",
    "completed_order_count",
    "revenue",
    *STATUS_COUNT_COLUMN.values(),
]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def count_failures(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """(name, failing_rows) of each row test, all from one pass over ``df``."""
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in tests.items()])
    names = [F.col(f"`{name}`") for name in tests]
    return counted.unpivot([], names, "name", "failing_rows")


def not_null(frames: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column_name, failing_rows) of every not-null test."""
    return _union(
        [
            count_failures(frames[name], {c: F.col(c).isNull() for c in columns}).select(
                F.lit(name).alias("dataset"),
                F.col("name").alias("column_name"),
                "failing_rows",
            )
            for name, columns in NOT_NULL_COLUMNS.items()
        ]
    )


def _unknown_status() -> Column:
    return ~F.col("order_status").isin(ORDER_STATUSES)


def _negative() -> Column:
    return reduce(Column.__or__, [F.col(name) < 0 for name in NON_NEGATIVE_COLUMNS])


def _not_reconciled() -> Column:
    total = reduce(Column.__add__, [F.col(c) for c in STATUS_COUNT_COLUMN.values()])
    return F.col("order_event_count") != total


def unknown_statuses(status_table: DataFrame) -> DataFrame:
    """Rows with a status outside the contract; a null status is no value."""
    return status_table.filter(_unknown_status())


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)


def repeated_source_grains(metrics_table: DataFrame, status_table: DataFrame) -> DataFrame:
    """One row, naming its table, per repeated key of the reporting tables."""
    return _union(
        [
            repeated_keys(df, keys).select(F.lit(name).alias("source_name"))
            for name, df, keys in (
                ("order_metrics_hourly", metrics_table, METRICS_KEY),
                ("order_status_hourly", status_table, STATUS_KEY),
            )
        ]
    )


def repeated_mart_grains(mart: DataFrame) -> DataFrame:
    return repeated_keys(mart, MART_KEY)


def negative_measures(mart: DataFrame) -> DataFrame:
    """Mart rows where any count or the revenue is below zero."""
    return mart.filter(_negative())


def unreconciled(mart: DataFrame) -> DataFrame:
    """Mart rows whose status counts do not add up to the event count."""
    return mart.filter(_not_reconciled())


# -- table constraints ----------------------------------------------------------


def _filled(columns: list[str]) -> dict[str, Column]:
    return {f"{name} not null": F.col(name).isNull() for name in columns}


def _count_checks(columns: list[str]) -> dict[str, Column]:
    return {f"{name} >= 0": F.col(name) < 0 for name in columns}


def _window_order() -> dict[str, Column]:
    return {"window_end > window_start": F.col("window_end") <= F.col("window_start")}


def metrics_constraints() -> dict[str, Column]:
    """Violation predicate of each row constraint of the metrics table."""
    counts = ["order_event_count", "created_order_count", "completed_order_count"]
    required = ["window_start", "window_end", "currency", *counts, "revenue", "aggregated_at", "loaded_at"]
    return {
        **_filled(required),
        "currency length <= 3": F.length("currency") > 3,
        **_window_order(),
        **_count_checks([*counts, "revenue"]),
    }


def status_constraints() -> dict[str, Column]:
    """Violation predicate of each row constraint of the status table."""
    required = [*STATUS_KEY, "window_end", "status_event_count", "aggregated_at", "loaded_at"]
    return {
        **_filled(required),
        "currency length <= 3": F.length("currency") > 3,
        "order_status length <= 30": F.length("order_status") > 30,
        **_window_order(),
        **_count_checks(["status_event_count"]),
    }


def store_constraints() -> dict[str, Column]:
    """Violation predicate of each row constraint of the event store."""
    return _filled(
        [
            "event_id",
            "event_type",
            "event_version",
            "order_id",
            "customer_id",
            "order_status",
            "order_amount",
            "event_time",
            "ingested_at",
            "raw_event",
        ]
    )


def constraint_violations(
    df: DataFrame, checks: dict[str, Column], key: list[str]
) -> DataFrame:
    """(constraint_name, failing_rows) of every row constraint and of the key.

    The row constraints share one pass. The key is counted by a grouped pass that
    combines before its shuffle; a repeated key counts once.
    """
    rows = count_failures(df, checks).withColumnRenamed("name", "constraint_name")
    repeated = repeated_keys(df, key).agg(F.count("*").alias("failing_rows"))
    return rows.unionByName(
        repeated.select(F.lit(f"unique {','.join(key)}").alias("constraint_name"), "failing_rows")
    )


class ConstraintError(ValueError):
    """Raised before a write that would break a table constraint."""


def enforce(tables: dict[str, tuple[DataFrame, dict[str, Column], list[str]]]) -> None:
    """Raise unless each frame may be written to the table it is named for.

    ``tables`` maps a name to its rows, row constraints and key.
    """
    found = _union(
        [
            constraint_violations(df, checks, key).withColumn("table_name", F.lit(name))
            for name, (df, checks, key) in tables.items()
        ]
    )
    broken = found.filter("failing_rows > 0").collect()
    if broken:
        detail = ", ".join(
            f"{r.table_name}: {r.constraint_name} ({r.failing_rows})" for r in broken
        )
        raise ConstraintError(detail)


# -- the suite ------------------------------------------------------------------


class QualityError(RuntimeError):
    """Raised when a suite has failing rows."""


def run_suite(frames: dict[str, DataFrame]) -> DataFrame:
    """All 24 tests as (test_name, failing_rows, passed).

    ``frames`` holds the datasets named in NOT_NULL_COLUMNS. All tests on the rows
    of a dataset share one pass over it; only the uniqueness tests group.
    """
    by_row = {
        dataset: {f"not_null_{dataset}_{c}": F.col(c).isNull() for c in columns}
        for dataset, columns in NOT_NULL_COLUMNS.items()
    }
    by_row["order_status_hourly"]["accepted_values_order_status_hourly_order_status"] = (
        _unknown_status()
    )
    by_row["fct_hourly_commerce_metrics"]["metrics_are_non_negative"] = _negative()
    by_row["fct_hourly_commerce_metrics"]["status_counts_reconcile"] = _not_reconciled()
    grouped = {
        "source_grains_are_unique": repeated_source_grains(
            frames["order_metrics_hourly"], frames["order_status_hourly"]
        ),
        "mart_grain_is_unique": repeated_mart_grains(frames["fct_hourly_commerce_metrics"]),
    }
    parts = [count_failures(frames[dataset], tests) for dataset, tests in by_row.items()] + [
        failing.agg(F.count("*").alias("failing_rows")).select(
            F.lit(name).alias("name"), "failing_rows"
        )
        for name, failing in grouped.items()
    ]
    return _union(parts).select(
        F.col("name").alias("test_name"),
        "failing_rows",
        (F.col("failing_rows") == 0).alias("passed"),
    )


def require_passing(suite: DataFrame) -> None:
    """Raise with the names of the failing tests, if there are any."""
    failed = suite.filter(~F.col("passed")).orderBy("test_name").collect()
    if failed:
        detail = ", ".join(f"{r.test_name} ({r.failing_rows})" for r in failed)
        raise QualityError(f"data tests failed: {detail}")

"""Keyed merge of new rows into a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.dedup import keep_first
from orderlake.schemas import (
    METRICS_KEY,
    METRICS_TABLE,
    STATUS_KEY,
    STATUS_TABLE,
    conform,
)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], newest_first: list[Column]
) -> DataFrame:
    """``target`` after inserting or replacing the rows of ``source``.

    Of several source rows for one key the first in ``newest_first`` order wins.
    Rows of the target without a source row stay as they are; none is deleted.
    Both frames have the columns of the target.
    """
    latest = keep_first(source, keys, newest_first)
    # Distinct combines before the shuffle: a key repeated in the source weighs
    # no more than any other, and a small source ends up broadcast by Spark.
    touched = source.select(keys).distinct()
    untouched = target.join(touched, keys, "left_anti")
    return untouched.select(target.columns).unionByName(latest.select(target.columns))


def upsert_metrics(target: DataFrame, gold_metrics: DataFrame) -> DataFrame:
    """Merge gold metrics into the reporting table, stamping loaded_at."""
    source = conform(gold_metrics.drop("loaded_at"), METRICS_TABLE)
    newest = [F.col("aggregated_at").desc()] + [
        F.col(name).desc()
        for name in METRICS_TABLE.fieldNames()
        if name not in (*METRICS_KEY, "aggregated_at", "loaded_at")
    ]
    return upsert(target, source, METRICS_KEY, newest)


def upsert_status(target: DataFrame, gold_status: DataFrame) -> DataFrame:
    """Merge the gold status distribution into its reporting table."""
    source = conform(gold_status.drop("loaded_at"), STATUS_TABLE)
    newest = [
        F.col(name).desc() for name in ("aggregated_at", "window_end", "status_event_count")
    ]
    return upsert(target, source, STATUS_KEY, newest)

"""Silver and quarantine: the two halves of bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.rules import all_rules_hold, failed_codes, is_valid
from orderlake.operators.dedup import dedup_events
from orderlake.schemas import QUARANTINE, SILVER


def select_valid(bronze: DataFrame) -> DataFrame:
    """Bronze rows that break no rule, before deduplication."""
    return bronze.filter(all_rules_hold()).withColumn(
        "validated_at", F.current_timestamp()
    )


def to_silver(bronze: DataFrame, delay: str = "7 days") -> DataFrame:
    """Valid events, one per event_id, dated by event time."""
    wanted = [name for name in SILVER.fieldNames() if name != "event_date"]
    valid = select_valid(bronze).select(wanted)
    return dedup_events(valid, delay).withColumn("event_date", F.to_date("event_time"))


def to_quarantine(bronze: DataFrame) -> DataFrame:
    """Invalid rows with the raw text and every reason they failed for."""
    return (
        bronze.filter(~is_valid())
        .withColumns({"validation_errors": failed_codes(), "validated_at": F.current_timestamp()})
        .withColumn("quarantine_date", F.to_date("validated_at"))
        .select(QUARANTINE.fieldNames())
    )

"""The twenty lake rules that decide between silver and quarantine.

Two views of one rule set: :func:`failed_codes` names every broken rule of a
row, :func:`all_rules_hold` only answers yes or no. The second is a plain
conjunction of comparisons, so Spark short-circuits it, compiles it and pushes
most of it down to the Parquet scan of the bronze files.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.contract import (
    CURRENCY_REGEX,
    EVENT_TYPES,
    ORDER_STATUSES,
    UUID_REGEX,
)


class Rule(NamedTuple):
    """``broken`` is true where the rule fails; null counts as not broken."""

    code: str
    broken: Column


def lake_rules() -> list[Rule]:
    """All rules, in the order in which their codes are reported."""
    c = F.col
    return [
        Rule("invalid_json", ~c("is_valid_json")),
        Rule("missing_event_id", c("event_id").isNull()),
        Rule("invalid_event_id", ~c("event_id").rlike(UUID_REGEX)),
        Rule("missing_order_id", c("order_id").isNull()),
        Rule("invalid_order_id", ~c("order_id").rlike(UUID_REGEX)),
        Rule("missing_customer_id", c("customer_id").isNull()),
        Rule("invalid_customer_id", ~c("customer_id").rlike(UUID_REGEX)),
        Rule("missing_event_time", c("event_time").isNull()),
        Rule("missing_event_version", c("event_version").isNull()),
        Rule("invalid_event_version", c("event_version") < 1),
        Rule("missing_event_type", c("event_type").isNull()),
        Rule("invalid_event_type", ~c("event_type").isin(EVENT_TYPES)),
        Rule("missing_order_status", c("order_status").isNull()),
        Rule("invalid_order_status", ~c("order_status").isin(ORDER_STATUSES)),
        Rule("missing_order_amount", c("order_amount").isNull()),
        Rule("non_positive_order_amount", c("order_amount") <= 0),
        Rule("missing_currency", c("currency").isNull()),
        Rule("invalid_currency", ~c("currency").rlike(CURRENCY_REGEX)),
        Rule("missing_message_key", c("message_key").isNull()),
        Rule("message_key_order_id_mismatch", c("message_key") != c("order_id")),
    ]


def all_rules_hold() -> Column:
    """True where no rule is broken; null or false elsewhere (fit for filter)."""
    c = F.col
    return (
        ~c("is_valid_json").eqNullSafe(F.lit(False))
        & c("event_time").isNotNull()
        & (c("event_version") >= 1)
        & c("event_type").isin(EVENT_TYPES)
        & c("order_status").isin(ORDER_STATUSES)
        & (c("order_amount") > 0)
        # Null-safe, or Spark infers the UUID pattern for the key as well. The
        # pattern of order_id below keeps two nulls out.
        & c("message_key").eqNullSafe(c("order_id"))
        & c("currency").rlike(CURRENCY_REGEX)
        & c("event_id").rlike(UUID_REGEX)
        & c("order_id").rlike(UUID_REGEX)
        & c("customer_id").rlike(UUID_REGEX)
    )


def is_valid() -> Column:
    """:func:`all_rules_hold` with null turned into false."""
    return F.coalesce(all_rules_hold(), F.lit(False))


def failed_codes() -> Column:
    """array<string> of the codes of all broken rules, in rule order."""
    codes = F.array(*[F.when(rule.broken, F.lit(rule.code)) for rule in lake_rules()])
    return F.array_compact(codes)


def with_validation(bronze: DataFrame) -> DataFrame:
    """Add validation_errors, is_valid and validated_at to bronze rows."""
    nothing = F.array().cast("array<string>")
    return bronze.withColumns(
        {
            # Most rows are valid: only the others pay for building the array.
            "validation_errors": F.when(is_valid(), nothing).otherwise(failed_codes()),
            "is_valid": is_valid(),
            "validated_at": F.current_timestamp(),
        }
    )

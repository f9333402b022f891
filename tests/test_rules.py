"""The lake rules, row by row."""

import json

import pytest
from builders import CUSTOMER_ID, ORDER_ID, bronze, event
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.functions.rules import lake_rules, with_validation
from orderlake.operators.silver import select_valid, to_quarantine

MISSING = [
    "missing_event_id",
    "missing_order_id",
    "missing_customer_id",
    "missing_event_time",
    "missing_event_version",
    "missing_event_type",
    "missing_order_status",
    "missing_order_amount",
    "missing_currency",
]
DUPLICATE_KEY = event()[:-1] + ', "currency": "USD"}'

CASES = [
    ("good", event(), []),
    ("not json", "this-is-not-json", ["invalid_json", *MISSING]),
    ("tombstone", None, ["invalid_json", *MISSING]),
    ("empty", "", ["invalid_json", *MISSING]),
    ("json null", "null", MISSING),
    ("json array", "[1]", MISSING),
    ("single quotes", event().replace('"', "'"), ["invalid_json"]),
    ("repeated key", DUPLICATE_KEY, ["invalid_json"]),
    ("unknown field", event(extra=1), []),
    ("no event id", event(event_id=...), ["missing_event_id"]),
    ("bad event id", event(event_id="nope"), ["invalid_event_id"]),
    ("numeric event id", event(event_id=12), ["invalid_event_id"]),
    ("no order id", event(order_id=...), ["missing_order_id"]),
    ("bad order id", ("nope", event(order_id="nope")), ["invalid_order_id"]),
    ("no customer id", event(customer_id=...), ["missing_customer_id"]),
    ("bad customer id", event(customer_id="nope"), ["invalid_customer_id"]),
    ("no time", event(event_time=...), ["missing_event_time"]),
    ("junk time", event(event_time="yesterday-ish"), ["missing_event_time"]),
    ("naive time", event(event_time="2026-08-01T10:15:00"), []),
    ("no version", event(event_version=...), ["missing_event_version"]),
    ("text version", event(event_version="1"), ["missing_event_version"]),
    ("zero version", event(event_version=0), ["invalid_event_version"]),
    ("no type", event(event_type=...), ["missing_event_type"]),
    ("odd type", event(event_type="order_lost"), ["invalid_event_type"]),
    ("no status", event(order_status=...), ["missing_order_status"]),
    ("odd status", event(order_status="shipped"), ["invalid_order_status"]),
    ("no amount", event(order_amount=...), ["missing_order_amount"]),
    ("zero amount", event(order_amount="0.00"), ["non_positive_order_amount"]),
    ("negative amount", event(order_amount="-1"), ["non_positive_order_amount"]),
    ("rounded amount", event(order_amount="10.995"), []),
    ("amount rounded to zero", event(order_amount="0.004"), ["non_positive_order_amount"]),
    ("huge amount", event(order_amount="99999999999.99"), ["missing_order_amount"]),
    ("no currency", event(currency=...), ["missing_currency"]),
    ("small currency", event(currency="usd"), ["invalid_currency"]),
    ("no key", (None, event()), ["missing_message_key"]),
    ("other key", (CUSTOMER_ID, event()), ["message_key_order_id_mismatch"]),
    ("key in capitals", (ORDER_ID.upper(), event()), ["message_key_order_id_mismatch"]),
    (
        "three at once",
        event(event_id="x", order_amount="0", currency="us"),
        ["invalid_event_id", "non_positive_order_amount", "invalid_currency"],
    ),
]


@pytest.fixture(scope="module")
def checked(spark):
    rows = with_validation(bronze(spark, [value for _, value, _ in CASES])).collect()
    return {row.kafka_offset: row for row in rows}


@pytest.mark.parametrize("index", range(len(CASES)), ids=[c[0] for c in CASES])
def test_codes(checked, index):
    row = checked[index]
    assert row.validation_errors == CASES[index][2]
    assert row.is_valid == (CASES[index][2] == [])


def test_every_rule_is_covered(spark):
    seen = {code for _, _, codes in CASES for code in codes}
    assert seen == {rule.code for rule in lake_rules()}


def test_amount_is_rounded_half_up(checked):
    index = [c[0] for c in CASES].index("rounded amount")
    assert str(checked[index].order_amount) == "11.00"


def test_split_loses_nothing(spark):
    df = bronze(spark, [value for _, value, _ in CASES])
    valid = {r.kafka_offset for r in select_valid(df).collect()}
    invalid = {r.kafka_offset for r in to_quarantine(df).collect()}
    assert valid == {i for i, c in enumerate(CASES) if not c[2]}
    assert valid | invalid == set(range(len(CASES))) and not valid & invalid


FIELD = st.sampled_from([..., None, "", "nope", 0, -1, 1, "USD", "pending", ORDER_ID, [], {}, True])
PAYLOAD = st.fixed_dictionaries(
    {},
    optional={
        name: FIELD
        for name in ("event_id", "order_id", "event_version", "order_amount", "currency", "order_status")
    },
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, ORDER_ID, "k"]), PAYLOAD), min_size=20, max_size=60))
def test_both_views_of_the_rules_agree(spark, drawn):
    """The short predicate is true exactly where the list of codes is empty."""
    values = [(key, event(**changes)) for key, changes in drawn]
    rows = with_validation(bronze(spark, values)).withColumn(
        "codes", F.array_compact(F.array(*[F.when(r.broken, F.lit(r.code)) for r in lake_rules()]))
    )
    for row in rows.collect():
        assert row.is_valid == (row.codes == [])
        assert row.validation_errors == row.codes


def test_json_helper_drops_fields():
    assert "currency" not in json.loads(event(currency=...))

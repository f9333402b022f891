"""The strict contract, row by row."""

import re
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from builders import CUSTOMER_ID, EVENT_ID, ORDER_ID, event, messages

from orderlake.functions.strict import accepted, apply_contract
from orderlake.operators.bronze import envelope
from orderlake.schemas import EVENT_COLUMNS

CASES = [
    ("good", event(), []),
    ("other key", (CUSTOMER_ID, event()), []),
    ("no key", (None, event()), []),
    ("null payload", None, ["empty_payload"]),
    ("not json", "this-is-not-json", ["invalid_payload"]),
    ("json null", "null", ["invalid_payload"]),
    ("text after it", event() + " more", ["invalid_payload"]),
    ("two objects", event() + "," + event(), ["invalid_payload"]),
    ("single quotes", event().replace('"', "'"), ["invalid_payload"]),
    ("repeated key", event()[:-1] + ', "currency": "EUR"}', []),
    ("defaults", event(event_id=..., event_version=..., currency=..., event_time=...), []),
    ("explicit null id", event(event_id=None), ["invalid_event_id"]),
    ("null currency", event(currency=None), ["invalid_currency"]),
    ("bare id", event(order_id=ORDER_ID.replace("-", "").upper()), []),
    ("bad id", event(customer_id="nope"), ["invalid_customer_id"]),
    ("numeric id", event(customer_id=12), ["invalid_customer_id"]),
    ("no order", event(order_id=...), ["missing_order_id"]),
    ("odd type", event(event_type="order_lost"), ["invalid_event_type"]),
    ("no type", event(event_type=...), ["missing_event_type"]),
    ("odd status", event(order_status="shipped"), ["invalid_order_status"]),
    ("text version", event(event_version="2"), []),
    ("whole float version", event(event_version=2.0), []),
    ("broken version", event(event_version=1.5), ["invalid_event_version"]),
    ("zero version", event(event_version=0), ["invalid_event_version"]),
    ("number amount", event(order_amount=12.5), []),
    ("trailing zeros", event(order_amount="12.5000"), []),
    ("zero amount", event(order_amount="0"), ["non_positive_order_amount"]),
    ("three decimals", event(order_amount="10.995"), ["order_amount_too_many_digits"]),
    ("eleven digits", event(order_amount="12345678901"), ["order_amount_too_many_digits"]),
    ("tiny tail", event(order_amount="1.0000000000000000000001"), ["order_amount_too_many_digits"]),
    ("most digits", event(order_amount="9999999999.99"), []),
    ("word amount", event(order_amount="ten"), ["invalid_order_amount"]),
    ("boolean amount", event(order_amount=True), ["invalid_order_amount"]),
    ("no amount", event(order_amount=...), ["missing_order_amount"]),
    ("small currency", event(currency="usd"), []),
    ("padded currency", event(currency=" eur "), []),
    ("long currency", event(currency="euro"), ["invalid_currency"]),
    ("numeric currency", event(currency=123), ["invalid_currency"]),
    ("naive time", event(event_time="2026-08-01T10:15:00"), ["event_time_without_zone"]),
    ("date only", event(event_time="2026-08-01"), ["event_time_without_zone"]),
    ("other zone", event(event_time="2026-08-01T18:15:00+08:00"), []),
    ("no seconds", event(event_time="2026-08-01T10:15Z"), []),
    ("epoch", event(event_time=1785579300), []),
    ("epoch millis", event(event_time=1785579300000), []),
    ("junk time", event(event_time="soon"), ["invalid_event_time"]),
    ("month 13", event(event_time="2026-13-01T10:15:00Z"), ["invalid_event_time"]),
    ("several", event(order_id="x", order_amount="0"), ["invalid_order_id", "non_positive_order_amount"]),
]
NAMES = [c[0] for c in CASES]


@pytest.fixture(scope="module")
def checked(spark):
    df = apply_contract(envelope(messages(spark, [value for _, value, _ in CASES])))
    return {NAMES[row.kafka_offset]: row for row in df.collect()}


@pytest.mark.parametrize("name,codes", [(c[0], c[2]) for c in CASES], ids=NAMES)
def test_codes(checked, name, codes):
    assert checked[name].contract_errors == codes
    assert checked[name].is_accepted == (codes == [])


def test_accepted_keeps_only_good_ones(spark):
    df = accepted(apply_contract(envelope(messages(spark, [c[1] for c in CASES]))))
    assert {NAMES[r.kafka_offset] for r in df.collect()} == {c[0] for c in CASES if not c[2]}


def test_values_are_normalised(checked):
    assert checked["good"].event_id == EVENT_ID
    assert checked["bare id"].order_id == ORDER_ID
    assert checked["small currency"].currency == "USD"
    assert checked["padded currency"].currency == "EUR"
    assert checked["repeated key"].currency == "EUR"
    assert checked["number amount"].order_amount == Decimal("12.50")
    assert checked["text version"].event_version == 2
    # Collected times are naive in the Python process's own zone.
    expected = datetime(2026, 8, 1, 10, 15, tzinfo=timezone.utc).timestamp()
    for name in ("other zone", "no seconds", "epoch", "epoch millis"):
        assert checked[name].event_time.timestamp() == expected, name


def test_defaults(checked):
    row = checked["defaults"]
    assert row.event_version == 1 and row.currency == "USD"
    assert row.event_time is not None and len(row.event_id) == 36


def test_made_up_id_is_the_same_on_replay(spark):
    df = apply_contract(envelope(messages(spark, [event(event_id=...), event(event_id=...)])))
    first = [r.event_id for r in df.orderBy("kafka_offset").collect()]
    again = [r.event_id for r in df.orderBy("kafka_offset").collect()]
    assert first == again and len(set(first)) == 2


def test_each_step_is_small_enough_for_the_jvm_to_compile(spark, tmp_path, capsys):
    """The JVM only interprets a method of over 8000 bytes."""
    envelope(messages(spark, [event()])).write.parquet(str(tmp_path / "sent"))
    accepted(apply_contract(spark.read.parquet(str(tmp_path / "sent")))).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_usual_spellings_are_read_like_any_other(spark):
    usual = event()
    other = event(
        event_id="urn:uuid:{" + EVENT_ID.upper() + "}",
        order_id=ORDER_ID.replace("-", ""),
        customer_id=CUSTOMER_ID.upper(),
        currency=" usd ",
        event_time="2026-08-01_10:15Z",
    )
    rows = accepted(apply_contract(envelope(messages(spark, [usual, other]))))
    assert rows.count() == 2
    assert rows.select(EVENT_COLUMNS).distinct().count() == 1

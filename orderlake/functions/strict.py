"""The strict event contract of the event store lane.

It differs from the lake rules on purpose: missing ids, times, versions and
currencies take defaults, lower-case currencies are accepted, the message key
is not looked at, and a time without a zone or an amount with too many digits
is refused instead of being repaired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType, VariantType

from orderlake.functions.contract import (
    DEFAULT_CURRENCY,
    DEFAULT_EVENT_VERSION,
    EVENT_TYPES,
    ORDER_STATUSES,
)
from orderlake.functions.once import compute_once
from orderlake.schemas import AMOUNT, EVENT_COLUMNS

# Spellings the contract accepts ------------------------------
ANY_UUID_REGEX = (
    r"^(urn:uuid:)?("
    r"[0-9a-fA-F]{32}"
    r"|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|\{[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\}"
    r")\z"
)
WHOLE_NUMBER_REGEX = r"^\s*[+-]?\d+(\.0+)?\s*\z"
NUMBER_REGEX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
ZONED_TIME_REGEX = (
    r"^\d{4}-\d{2}-\d{2}[Tt _]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})\z"
)
ZONELESS_TIME_REGEX = r"^\d{4}-\d{2}-\d{2}([Tt _]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?\z"
# The usual spellings, which are taken as they are.
CANONICAL_UUID_REGEX = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
CANONICAL_TIME_REGEX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z\z"
CANONICAL_CURRENCY_REGEX = r"^[A-Z]{3}\z"
#: Epoch numbers beyond this are milliseconds, not seconds.
EPOCH_SECONDS_LIMIT = 20_000_000_000
# --------------------------------------------------------------------------

#: Event columns whose values are read in one step.
_READ_TOGETHER = (
    ("event_id", "order_id", "customer_id"),
    ("event_type", "event_version", "order_status", "order_amount", "currency"),
    ("event_time",),
)
_PAYLOAD = ArrayType(StructType([StructField(n, VariantType()) for n in EVENT_COLUMNS]))


class _Given:
    """One field of the payload: whether it was sent, as what type and text.

    Works on the columns that :func:`_taken_apart` makes.
    """

    def __init__(self, name: str):
        self.text, kind = F.col(f"_text_{name}"), F.col(f"_kind_{name}")
        self.absent = kind.isNull()
        self.is_string = kind == "STRING"
        self.is_boolean = kind == "BOOLEAN"
        self.is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")

    def among(self, allowed: list[str]) -> Column:
        return self.is_string & self.text.isin(allowed)


def _taken_apart() -> dict[str, Column]:
    """Text and type of each field. A field that was not sent has a null type, a
    JSON null the type VOID."""
    columns = {}
    for name in EVENT_COLUMNS:
        value = F.col("_payload")[name]
        columns[f"_text_{name}"] = F.try_variant_get(value, "$", "string")
        columns[f"_kind_{name}"] = F.schema_of_variant(value)
    return columns


def _uuid(given: _Given) -> Column:
    """Canonical lower-case UUID, or null."""
    digits = F.regexp_replace(F.lower(given.text), r"^urn:uuid:|[{}\-]", "")
    dashed = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(given.is_string & given.text.rlike(CANONICAL_UUID_REGEX), given.text).when(
        given.is_string & given.text.rlike(ANY_UUID_REGEX), dashed
    )


def _version(given: _Given) -> Column:
    whole = (given.is_string | given.is_number) & given.text.rlike(WHOLE_NUMBER_REGEX)
    return (
        F.when(given.is_boolean, (given.text == "true").cast("int"))
        .when(whole, F.trim(given.text).try_cast("decimal(38,6)").try_cast("int"))
    )


def _number(given: _Given) -> Column:
    readable = (given.is_string | given.is_number) & given.text.rlike(NUMBER_REGEX)
    return F.when(readable, F.trim(given.text).try_cast("decimal(38,18)"))


def _amount_fits(given: _Given, number: Column) -> Column:
    """At most two decimals and ten digits before the point."""
    tail = F.regexp_extract(F.trim(given.text), r"^[^eE]*?\.(\d*?)0*$", 1)
    return (
        (number == F.round(number, 2))
        & (F.length(tail) <= 2)
        & (F.abs(number) < F.lit(10**10))
    )


def _instant(given: _Given) -> Column:
    """The instant of a zoned ISO text or of an epoch number, or null."""
    iso = F.regexp_replace(F.upper(given.text), "_", " ")
    with_seconds = F.regexp_replace(iso, r"^(.{16})(?=[Z+\-])", "$1:00")
    epoch = F.when(
        (given.is_string | given.is_number) & given.text.rlike(NUMBER_REGEX),
        F.trim(given.text).try_cast("decimal(38,6)"),
    )
    scale = F.when(F.abs(epoch) > EPOCH_SECONDS_LIMIT, 1000).otherwise(1_000_000)
    return F.when(
        given.is_string & given.text.rlike(CANONICAL_TIME_REGEX),
        given.text.try_cast("timestamp"),
    ).when(
        given.is_string & given.text.rlike(ZONED_TIME_REGEX),
        with_seconds.try_cast("timestamp"),
    ).otherwise(F.timestamp_micros((epoch * scale).try_cast("bigint")))


def _currency(given: _Given) -> Column:
    stripped = F.regexp_replace(given.text, r"(?U)^\s+|\s+\z", "")
    return F.when(
        given.is_string & given.text.rlike(CANONICAL_CURRENCY_REGEX), given.text
    ).when(given.is_string & (F.length(stripped) == 3), F.upper(stripped))


def _fresh_id(df: DataFrame) -> Column:
    """An id for an event that came without one.

    With a transport position at hand the id is derived from it, so that a
    replayed micro-batch or a retried task makes the same id again.
    """
    place = ["kafka_topic", "kafka_partition", "kafka_offset"]
    if not set(place) <= set(df.columns):
        return F.uuid()
    digest = F.md5(F.concat_ws("/", *place))
    return F.regexp_replace(
        digest, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-4$3-8$4-$5"
    )


def apply_contract(df: DataFrame, payload: str = "raw_event") -> DataFrame:
    """Parse and check the JSON text in ``payload``.

    Adds the nine normalised event columns, is_accepted, and contract_errors, an
    array with the code of each broken term; it is empty for an accepted event.
    Columns of ``df`` that share a name with an event column are replaced.
    """
    # Wrapped in brackets, so that text after the object breaks the parse.
    wrapped = F.concat(F.lit("["), F.col(payload), F.lit("]"))
    items = F.from_json(wrapped, _PAYLOAD, {"allowSingleQuotes": "false"})
    # Each step runs once per row: parse, unwrap, take apart, read the values. Spark
    # compiles a step to one method, and the JVM only interprets a method of over 8000
    # bytes, so the values are read in several steps.
    parsed = compute_once(df, _items=items)
    sole = F.when(F.size("_items") == 1, F.get("_items", F.lit(0)))
    unwrapped = compute_once(parsed, _payload=sole).drop("_items")
    fields = compute_once(
        unwrapped, _is_object=F.col("_payload").isNotNull(), **_taken_apart()
    ).drop("_payload")

    g = {name: _Given(name) for name in EVENT_COLUMNS}
    values = {
        "event_id": _uuid(g["event_id"]),
        "event_type": F.when(g["event_type"].among(EVENT_TYPES), g["event_type"].text),
        "event_version": _version(g["event_version"]),
        "order_id": _uuid(g["order_id"]),
        "customer_id": _uuid(g["customer_id"]),
        "order_status": F.when(
            g["order_status"].among(ORDER_STATUSES), g["order_status"].text
        ),
        "order_amount": _number(g["order_amount"]),
        "currency": _currency(g["currency"]),
        "event_time": _instant(g["event_time"]),
    }
    at = g["event_time"]
    read = fields
    for names in _READ_TOGETHER:
        read = compute_once(read, **{f"_read_{name}": values[name] for name in names})
    read = compute_once(
        read,
        _amount_fits=_amount_fits(g["order_amount"], F.col("_read_order_amount")),
        _zoneless=at.is_string & at.text.rlike(ZONELESS_TIME_REGEX),
    )
    clean = {name: F.col(f"_read_{name}") for name in EVENT_COLUMNS}
    number, fits, zoneless = clean["order_amount"], F.col("_amount_fits"), F.col("_zoneless")

    def required(name: str) -> list[Column]:
        return [
            F.when(g[name].absent, F.lit(f"missing_{name}")),
            F.when(~g[name].absent & clean[name].isNull(), F.lit(f"invalid_{name}")),
        ]

    def optional(name: str) -> list[Column]:
        return [F.when(~g[name].absent & clean[name].isNull(), F.lit(f"invalid_{name}"))]

    field_codes = [
        *optional("event_id"),
        *required("event_type"),
        F.when(
            ~g["event_version"].absent & ~F.coalesce(clean["event_version"] >= 1, F.lit(False)),
            F.lit("invalid_event_version"),
        ),
        *required("order_id"),
        *required("customer_id"),
        *required("order_status"),
        F.when(g["order_amount"].absent, F.lit("missing_order_amount")),
        F.when(~g["order_amount"].absent & number.isNull(), F.lit("invalid_order_amount")),
        F.when(number <= 0, F.lit("non_positive_order_amount")),
        F.when(~fits, F.lit("order_amount_too_many_digits")),
        *optional("currency"),
        F.when(zoneless, F.lit("event_time_without_zone")),
        F.when(
            ~at.absent & clean["event_time"].isNull() & ~F.coalesce(zoneless, F.lit(False)),
            F.lit("invalid_event_time"),
        ),
    ]
    payload_code = F.when(F.col(payload).isNull(), F.lit("empty_payload")).when(
        ~F.col("_is_object"), F.lit("invalid_payload")
    )
    errors = F.when(payload_code.isNotNull(), F.array(payload_code)).otherwise(
        F.array_compact(F.array(*field_codes))
    )
    defaults = {
        "event_id": _fresh_id(df),
        "event_version": F.lit(DEFAULT_EVENT_VERSION),
        "currency": F.lit(DEFAULT_CURRENCY),
        "event_time": F.current_timestamp(),
    }

    def settled(name: str) -> Column:
        if name == "order_amount":
            return F.when(fits, number.try_cast(AMOUNT))
        if name in defaults:
            return F.when(g[name].absent, defaults[name]).otherwise(clean[name])
        return clean[name]

    carried = [name for name in df.columns if name not in EVENT_COLUMNS]
    return read.select(
        *carried,
        errors.alias("contract_errors"),
        F.coalesce(payload_code, *field_codes).isNull().alias("is_accepted"),
        *[settled(name).alias(name) for name in EVENT_COLUMNS],
    )


def accepted(checked: DataFrame) -> DataFrame:
    """Events that meet the contract; everything else is left out."""
    return checked.filter("is_accepted").drop("is_accepted", "contract_errors")

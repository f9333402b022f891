"""UTC handling of timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def to_utc(df: DataFrame, *names: str, source_zone: str | None = None) -> DataFrame:
    """Turn the named columns into instants.

    A zoned timestamp already is an instant. A zoneless one is read as UTC, or
    as wall time of ``source_zone`` where one is given.
    """
    zone = F.lit(source_zone or "UTC")
    changed = {}
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, TimestampNTZType):
            changed[name] = _instant(F.col(name), zone)
        elif not isinstance(kind, TimestampType):
            raise TypeError(f"{name} is {kind.simpleString()}, not a timestamp")
    return df.withColumns(changed) if changed else df


def _instant(wall_time: Column, zone: Column) -> Column:
    """The instant at which clocks of ``zone`` show ``wall_time``.

    Built from calendar fields, so the session time zone plays no part.
    """
    return F.make_timestamp(
        F.year(wall_time),
        F.month(wall_time),
        F.dayofmonth(wall_time),
        F.hour(wall_time),
        F.minute(wall_time),
        F.extract(F.lit("SECOND"), wall_time),
        zone,
    )


def iso_utc(instant: Column) -> Column:
    """ISO-8601 text in UTC with a trailing Z; a fraction only if there is one.

    Expects a session time zone of UTC.
    """
    seconds = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(instant, "SSSSSS")
    return F.concat(
        seconds,
        F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
        F.lit("Z"),
    )

"""Typed coercion of snapshot text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def measure(text: Column) -> Column:
    """Number or null: unparseable text and NaN both become null.

    A Java type suffix ("1d", "2f") parses as a number in Spark but is no number in JSON data.
    """
    number = text.try_cast("double")
    return F.when(F.isnan(number) | text.rlike("[0-9.][dDfF]\\s*$"), None).otherwise(number)


def strict_cast(text: Column, kind: str) -> Column:
    """Cast that raises on text it cannot read, whatever the session's ANSI setting."""
    value = text.try_cast(kind)
    return F.when(value.isNull() & text.isNotNull(), _unreadable(text, kind)).otherwise(value)


def utc_wall_time(text: Column) -> Column:
    """ISO timestamp with an offset as UTC wall-clock time without a zone.

    A direct cast to ``timestamp_ntz`` would drop the offset, and casting an instant would use
    the session's zone; counting from the epoch depends on neither.
    """
    instant = text.try_cast("timestamp")
    wall = F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )
    readable = instant.isNotNull() & text.rlike("([zZ]|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(text.isNotNull() & ~readable, _unreadable(text, "timestamp with offset")).otherwise(wall)


def _unreadable(text: Column, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"not a {kind}: "), text))

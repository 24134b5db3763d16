"""Time expressions.

Timestamps carry no zone (``timestamp_ntz``): local wall clock in Bronze, UTC from
Silver on. Nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/London"


def to_utc(col: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local wall clock -> UTC. A repeated hour takes its first (summer) reading."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col.cast("timestamp_ntz"))


def epoch_minute(col: Column) -> Column:
    """Minutes since 1970, counted from the calendar fields.

    ``timestampdiff`` would first read the value in the session's zone.
    """
    at = col.cast("timestamp_ntz")
    days = F.datediff(at.cast("date"), F.lit(date(1970, 1, 1))).cast("bigint")
    return days * 1440 + F.hour(at) * 60 + F.minute(at)


def epoch_micros(col: Column) -> Column:
    """Microseconds since 1970, likewise."""
    second = F.extract(F.lit("SECOND"), col.cast("timestamp_ntz"))
    return epoch_minute(col) * 60_000_000 + (second * 1_000_000).cast("bigint")


def from_epoch(unit: str, count: Column) -> Column:
    return F.timestamp_add(unit, count, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two instants: 00:00:59 to 00:01:00 is 1."""
    return epoch_minute(end) - epoch_minute(start)


def hour_start(col: Column) -> Column:
    """The full hour an instant lies in."""
    since = epoch_minute(col)
    return from_epoch("MINUTE", since - F.pmod(since, F.lit(60)))


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(end.cast("date"), start.cast("date"))


def month_start(col: Column) -> Column:
    return F.trunc(col.cast("date"), "MM")


def month_label(col: Column) -> Column:
    """``yyyy-MM`` of a date, or of text that is one; other text stays as it is."""
    text = col.cast("string")
    return F.coalesce(F.date_format(text.try_cast("date"), "yyyy-MM"), text)


def over_threshold(value: Column, limit: int) -> Column:
    """Breach flag that is never NULL: an unknown interval is not a breach."""
    return F.coalesce(value > F.lit(limit), F.lit(False))

"""Timestamp coercion.

Every event time is a UTC wall clock without zone (TIMESTAMP_NTZ) at second
precision.  None of these builders reads the session time zone: ``date_trunc``
and ``date_format`` promote NTZ to a zoned timestamp, so plain interval
arithmetic and string casts are used instead.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The year 1..9999 range a wall clock can hold, in epoch seconds.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799

# Accepted text shapes.  Space form: only the first 19 characters
# count.  ISO form: the whole text must match; group 1 is the wall clock.
SPACE_FORM = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
EVENT_FORM = (
    r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?"
    r"\s*(?:Z|[+-]\d{1,2}(?::?\d{2}(?::?\d{2})?)?)?)?\s*$"
)
ISO_FORM = (
    r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2})?)?)?)"
    r"(?:[.,]\d+)?(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?$"
)


def as_wall_clock(value: Column | datetime | str) -> Column:
    """A column, datetime or text given by the caller as a TIMESTAMP_NTZ column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def _seconds(n: Column) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, n.cast("decimal(18,6)"))


def wall_clock_from_epoch(seconds: Column) -> Column:
    """Whole epoch seconds -> UTC wall clock."""
    return as_wall_clock("1970-01-01 00:00:00") + _seconds(seconds)


def epoch_seconds(ts: Column) -> Column:
    """UTC wall clock -> whole epoch seconds."""
    day = F.unix_date(ts.cast("date")).cast("long")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def instant_to_wall_clock(ts: Column) -> Column:
    """Zoned timestamp -> UTC wall clock, fraction dropped."""
    return wall_clock_from_epoch(F.unix_seconds(ts))


def wall_clock_to_instant(ts: Column) -> Column:
    """UTC wall clock -> zoned timestamp, as event-time watermarks require."""
    return F.timestamp_seconds(epoch_seconds(ts))


def truncate_to_second(ts: Column) -> Column:
    second = F.second(ts).cast("decimal(8,6)")
    return ts - _seconds(F.extract(F.lit("SECOND"), ts) - second)


def floor_to_quarter(ts: Column) -> Column:
    """Floor a wall clock to its 15-minute bucket."""
    zero = F.lit(0)
    past = F.make_dt_interval(
        zero, zero, F.minute(ts) % 15, F.extract(F.lit("SECOND"), ts).cast("decimal(18,6)")
    )
    return ts - past


def event_time(text: Column) -> Column:
    """The wall clock of an event, at second precision; NULL where the text is none.

    A date is whole, an offset is dropped, and the year is one of 1..9999.
    """
    parsed = F.when(text.rlike(EVENT_FORM), text.try_cast("timestamp_ntz"))
    return F.when(F.year(parsed).between(1, 9999), truncate_to_second(parsed))


def _from_text(text: Column) -> Column:
    head = F.substring(text, 1, 19)
    iso = F.regexp_extract(text, ISO_FORM, 1)
    return F.when(head.rlike(SPACE_FORM), head.try_cast("timestamp_ntz")).otherwise(
        F.when(iso != "", iso.try_cast("timestamp_ntz"))
    )


def _from_number(number: Column) -> Column:
    value = number.cast("double")
    seconds = F.floor(F.when(value > 1e12, value / 1000).otherwise(value))
    return F.when(
        ~F.isnan(value) & value.between(FIRST_SECOND, LAST_SECOND * 1000.0),
        F.when(seconds.between(FIRST_SECOND, LAST_SECOND), wall_clock_from_epoch(seconds)),
    )


def normalize_ts(ts: Column, run_ts: Column | datetime | str, kind: str = "text") -> Column:
    """Coerce a value to a UTC wall clock at second precision.

    ``kind`` says what the column holds: ``text``, ``number`` (epoch seconds, or
    milliseconds above 1e12), ``wall_clock`` (TIMESTAMP_NTZ) or ``instant``
    (TIMESTAMP).  What cannot be coerced becomes ``run_ts``, the run's own time
    given as a parameter so that a run can be repeated.  An offset in text is
    dropped, not applied.
    """
    if kind == "text":
        parsed = _from_text(ts)
    elif kind == "number":
        parsed = _from_number(ts)
    elif kind == "wall_clock":
        parsed = truncate_to_second(ts)
    elif kind == "instant":
        parsed = instant_to_wall_clock(ts)
    else:
        raise ValueError(f"unknown kind: {kind}")
    return F.coalesce(parsed, as_wall_clock(run_ts))

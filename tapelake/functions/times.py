"""Timestamps, trading days and day ranges. Every rule is a UTC rule (the session runs in UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Microseconds since 1970 at 0001-01-01T00:00:00 and at 9999-12-31T23:59:59.999999.
MIN_MICROS = -62_135_596_800_000_000
MAX_MICROS = 253_402_300_799_999_999


def micros_to_timestamp(micros: Column) -> Column:
    """Epoch microseconds to timestamp; a value outside the years 1-9999 fails the job, null stays null."""
    return F.when(
        micros.isNull() | micros.between(MIN_MICROS, MAX_MICROS),
        F.timestamp_micros(micros),
    ).otherwise(F.raise_error(F.concat(F.lit("timestamp out of range: "), micros.cast("string"))))


def trading_day(ts: Column) -> Column:
    """The UTC calendar day of an instant."""
    return F.to_date(ts)


def time_of_day(ts: Column) -> Column:
    """UTC time of day with microseconds, as text."""
    return F.date_format(ts, "HH:mm:ss.SSSSSS")


def day_in_zone(ts: Column, zone: str) -> Column:
    """Calendar day of a UTC instant on the clock of ``zone``."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def time_in_zone(ts: Column, zone: str) -> Column:
    """Time of day of a UTC instant on the clock of ``zone``."""
    return time_of_day(F.from_utc_timestamp(ts, zone))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text with Z, an offset or neither (then UTC) to timestamp; null if it cannot be read."""
    return F.try_to_timestamp(F.trim(text))


def iso_day(text: Column) -> Column:
    """ISO-8601 text to its UTC calendar day; null if it cannot be read."""
    return F.to_date(iso_timestamp(text))


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def yesterday() -> Column:
    """The default day of a recurring load."""
    return F.date_sub(F.current_date(), 1)


def as_day(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def instant_like(df: DataFrame, column: str, value: dt.date | dt.datetime | str) -> Column:
    """A literal of the type of ``df[column]``, so that the comparison needs no cast and reaches the file reader."""
    text = value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value
    return F.lit(text).cast(df.schema[column].dataType)


def day_range(start: dt.date | str, end: dt.date | str | None = None) -> tuple[dt.date, dt.date]:
    """Check a date argument pair: one date, or start and end together with end not before start."""
    first = as_day(start)
    last = first if end is None else as_day(end)
    if last < first:
        raise ValueError(f"end day {last} is before start day {first}")
    return first, last


def date_mode(
    date: dt.date | str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> tuple[dt.date, dt.date]:
    """The two date modes of the batch jobs: exactly one of ``date`` or (``start`` and ``end``)."""
    if date is not None:
        if start is not None or end is not None:
            raise ValueError("give either date, or start and end")
        return day_range(date)
    if start is None or end is None:
        raise ValueError("give date, or both start and end")
    return day_range(start, end)


def days_between(start: Column, end: Column) -> Column:
    """Array of all days from start to end, both included; empty if end is before start."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))

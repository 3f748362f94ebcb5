"""Time parsing and the duration rules of the trip tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_point_time(text: Column) -> Column:
    """Lenient parse; text that is no time gives null. Keeps the wall clock of the text."""
    return text.try_cast("timestamp_ntz")


def parse_strict(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Strict parse by format; text in any other form gives null."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def date_part(ts: Column) -> Column:
    return F.to_date(ts)


def time_text(ts: Column) -> Column:
    """``HH:mm:ss`` as written, whatever the session time zone."""
    return F.substring(ts.cast("string"), 12, 8)


def clock_seconds(time: Column) -> Column:
    """Seconds since midnight of ``HH:mm:ss`` text."""
    part = lambda i: F.split_part(time, F.lit(":"), F.lit(i)).cast("bigint")
    return part(1) * 3600 + part(2) * 60 + part(3)


def combine(date: Column, time: Column) -> Column:
    return F.concat_ws(" ", date.cast("string"), time).try_cast("timestamp_ntz")


def clock_abs_seconds(start: Column, end: Column) -> Column:
    """Difference of the clock times, swapped if reversed; the date plays no part."""
    return F.abs(clock_seconds(end) - clock_seconds(start))


def clock_nonzero_seconds(start: Column, end: Column) -> Column:
    """As ``clock_abs_seconds``, but equal times give null."""
    return F.nullif(clock_abs_seconds(start, end), F.lit(0).cast("bigint"))


def view_seconds(start_date: Column, end_date: Column, start: Column, end: Column) -> Column:
    """View rule: null if the times are equal or the end date lies before the start date."""
    return F.when(start_date <= end_date, clock_nonzero_seconds(start, end))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """True elapsed whole seconds between two timestamps without zone."""
    return F.timestamp_diff("SECOND", start, end)


def duration_text(seconds: Column) -> Column:
    """Whole seconds as ``HH:MM:SS``; hours may go beyond 24."""
    s = F.floor(seconds).cast("bigint")
    hours = F.floor(s / 3600).cast("bigint")
    minutes = F.floor(s % 3600 / 60).cast("bigint")
    return F.format_string("%02d:%02d:%02d", hours, minutes, s % 60)

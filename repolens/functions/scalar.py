"""Scalar column functions (all JVM-side built-ins, codegen friendly).

Each helper returns a Column; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "c", "safe_timestamp", "utc_wallclock", "instant_wallclock", "part", "day_of_week", "iso_week", "date_key",
    "surrogate_key", "whole_hours", "owner_of", "left_chars",
    "day_start", "week_start", "month_start", "elapsed_seconds",
]


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_timestamp(x) -> Column:
    """``safe_cast(x as timestamp)``: malformed text gives NULL (never raises under ANSI)."""
    return c(x).try_cast("timestamp_ntz")


def utc_wallclock(x) -> Column:
    """Parse ISO-8601 text (with or without offset) to a UTC wall-clock ``timestamp_ntz``.

    Text with an offset names an instant, whose microseconds since the epoch
    are added to the epoch's wall clock; text without one is UTC.  Neither
    way passes through the session time zone.  Unparsable text gives NULL.
    """
    text = c(x).cast("string")
    has_offset = text.rlike(r"(?i)(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2}){0,2})$") & text.contains(":")
    return F.when(has_offset, instant_wallclock(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


def instant_wallclock(x) -> Column:
    """The UTC wall clock of a ``timestamp`` (an instant), in any session time zone."""
    seconds = F.unix_micros(c(x)).cast("decimal(24,6)") / F.lit(1000000).cast("decimal(7,0)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, seconds.cast("decimal(18,6)"))


def part(fn, x) -> Column:
    """A date part as bigint (the warehouse's INT64)."""
    return fn(c(x)).cast("bigint")


def day_of_week(x) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(c(x)).cast("bigint")


def iso_week(x) -> Column:
    """ISO-8601 week number 1..53."""
    return F.weekofyear(c(x)).cast("bigint")


def date_key(x) -> Column:
    """yyyymmdd as bigint, computed arithmetically (no string formatting)."""
    d = c(x)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def surrogate_key(x) -> Column:
    """64-bit surrogate key of a string: first 60 bits of its MD5, as bigint.

    Same role as a fingerprint hash; deterministic across engines.
    """
    return F.conv(F.substring(F.md5(c(x)), 1, 15), 16, 10).cast("bigint")


def whole_hours(start, end) -> Column:
    """Whole elapsed hours from start to end (truncated toward zero).

    ``end - start`` of two ``timestamp_ntz`` values is a day-time interval
    computed without any time zone, so the result is the same in every
    session time zone (``timestampdiff`` may shift across DST changes)."""
    return (c(end) - c(start)).cast("interval hour").cast("bigint")


def elapsed_seconds(start, end) -> Column:
    """Whole seconds from start to end, time-zone independent (see whole_hours)."""
    return (c(end) - c(start)).cast("interval second").cast("bigint")


def owner_of(full_name) -> Column:
    """``split(full_name, '/')[safe_offset(0)]``: the whole string if there is no slash."""
    return F.get(F.split(c(full_name), "/"), 0)


def left_chars(x, n: int) -> Column:
    """First ``n`` characters (not bytes)."""
    return F.substring(c(x), 1, n)


def day_start(x) -> Column:
    return F.to_date(c(x))


def week_start(x) -> Column:
    """Monday of the ISO week containing x, as a date (date arithmetic, no
    time zone involved: dayofweek 2 = Monday -> offset 0, 1 = Sunday -> 6)."""
    d = F.to_date(c(x))
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7)


def month_start(x) -> Column:
    return F.trunc(F.to_date(c(x)), "month")

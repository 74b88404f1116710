"""Event time, window bounds and date checks."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats in which instants are written.
MICROS_UTC = "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'"
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY = "yyyy-MM-dd"

_DAY_MICROS = 86_400_000_000


def event_time(value: Column) -> Column:
    """Event time as TIMESTAMP; watermarks do not take TIMESTAMP_NTZ or DATE."""
    return value.cast("timestamp")


def attribute_time(text: Column) -> Column:
    """Event time from a message attribute: milliseconds since 1970 or RFC 3339
    text; other text gives NULL."""
    millis = text.try_cast("bigint")
    return F.when(millis.isNotNull(), F.timestamp_millis(millis)).otherwise(text.try_cast("timestamp"))


def parse_day(text: Column) -> Column:
    """``YYYY-MM-DD`` text to a date; other text gives NULL."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def epoch_seconds(day: Column) -> Column:
    """Seconds since 1970 of the start of a day in UTC."""
    return F.unix_date(day).cast("bigint") * 86_400


def utc_day(instant: Column) -> Column:
    """The day of an instant in UTC, as a date."""
    return F.date_add(F.lit(date(1970, 1, 1)), F.floor(F.unix_micros(instant) / F.lit(_DAY_MICROS)).cast("int"))


def bound_text(instant: Column, fmt: str = MICROS_UTC) -> Column:
    """A TIMESTAMP as text in UTC, whatever the zone of the session is.

    It is put together from its microseconds: Spark's own formatter writes
    the time of the session zone, which leaves out and repeats hours.
    """
    if fmt not in (MICROS_UTC, RFC3339, DAY):
        raise ValueError(f"no such format: {fmt}")
    day = utc_day(instant).cast("string")
    if fmt == DAY:
        return day
    rest = F.pmod(F.unix_micros(instant), F.lit(_DAY_MICROS))
    seconds = (rest / 1_000_000).cast("int")
    clock = [F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60]
    parts = [F.lpad(x.cast("string"), 2, "0") for x in clock]
    time = F.concat_ws(":", *parts)
    if fmt == RFC3339:
        return F.concat(day, F.lit("T"), time, F.lit("Z"))
    micros = F.lpad((rest % 1_000_000).cast("string"), 6, "0")
    return F.concat(day, F.lit(" "), time, F.lit("."), micros, F.lit(" UTC"))


def check_day(text: str, first: date, last: date) -> str:
    """Check an argument before a plan is built: ``YYYY-MM-DD``, within bounds."""
    day = datetime.strptime(text, "%Y-%m-%d").date()
    if not first <= day <= last:
        raise ValueError(f"{text} lies outside {first} to {last}")
    return text

"""Device, log and day times.

Log times are ``yyyyMMddHHmmss`` text; inside the operators a time is a bigint
of epoch seconds, so ordering, range frames and differences stay numeric.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

LOG_FORMAT = "yyyyMMddHHmmss"
DAY_FORMAT = "yyyyMMdd"
DEVICE_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"
DEVICE_FORMAT_MS = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"
# The same formats as expressions; the general parser is several times slower
# than a cast, and a cast alone would accept many other spellings.
DEVICE_PATTERN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d[+-]\d{4}$"
DEVICE_PATTERN_MS = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}[+-]\d{4}$"
DAY_SECONDS = 86400


def shift_day(day: str, days: int) -> str:
    """Job-argument form: move a ``yyyyMMdd`` day."""
    return (datetime.strptime(day, "%Y%m%d") + timedelta(days=days)).strftime("%Y%m%d")


def halo_days(day: str, before: int = 1, after: int = 1) -> list[str]:
    return [shift_day(day, d) for d in range(-before, after + 1)]


def device_timestamp(raw: Column, milliseconds: bool = False) -> Column:
    """Device time as a timestamp; null when the text is no valid time."""
    pattern = DEVICE_PATTERN_MS if milliseconds else DEVICE_PATTERN
    return F.when(raw.rlike(pattern), raw.try_cast("timestamp"))


def device_time(raw: Column, plus_minutes: int = 0) -> Column:
    parsed = device_timestamp(raw)
    if plus_minutes:
        parsed = parsed + F.expr(f"INTERVAL {int(plus_minutes)} MINUTES")
    return F.date_format(parsed, LOG_FORMAT)


def device_time_ms(raw: Column) -> Column:
    return F.date_format(device_timestamp(raw, milliseconds=True), LOG_FORMAT + "SSS")


def to_epoch(log_time: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(log_time, F.lit(LOG_FORMAT)))


def from_epoch(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), LOG_FORMAT)


def day_of(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), DAY_FORMAT)


# Where a time lies, seen from the day of a job.
BEFORE, OWN, AFTER, ELSEWHERE = "before", "own", "after", "elsewhere"


def near_day(seconds: Column, day: str) -> Column:
    """One of four places, however many days the clocks of the boxes show; no time is elsewhere."""
    found = day_of(seconds)
    places = {shift_day(day, -1): BEFORE, day: OWN, shift_day(day, 1): AFTER}
    out = F.lit(ELSEWHERE)
    for name, place in places.items():
        out = F.when(found == name, F.lit(place)).otherwise(out)
    return out


def day_start(day: str | Column) -> Column:
    """Epoch second at which a ``yyyyMMdd`` day begins."""
    text = F.lit(day) if isinstance(day, str) else day
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(DAY_FORMAT)))


def plus_days(day: Column, days: int) -> Column:
    parsed = F.to_date(F.try_to_timestamp(day, F.lit(DAY_FORMAT)))
    return F.date_format(F.date_add(parsed, days), DAY_FORMAT)


def plus_seconds(log_time: Column, seconds: int) -> Column:
    return from_epoch(to_epoch(log_time) + F.lit(seconds))


def plus_minutes(log_time: Column, minutes: int) -> Column:
    return plus_seconds(log_time, 60 * minutes)


def seconds_between(start: Column, end: Column) -> Column:
    return to_epoch(end) - to_epoch(start)


def clock_seconds(clock: Column) -> Column:
    """``HH:mm:ss`` to seconds."""
    parts = F.split(clock, ":")
    hours, minutes, seconds = (F.get(parts, F.lit(i)).try_cast("bigint") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def compact_clock_seconds(clock: Column) -> Column:
    """``HHmmss`` to seconds."""
    hours, minutes, seconds = (
        F.substring(clock, at, 2).try_cast("bigint") for at in (1, 3, 5)
    )
    return hours * 3600 + minutes * 60 + seconds


def clock_duration(start: Column, end: Column) -> Column:
    return compact_clock_seconds(end) - compact_clock_seconds(start)

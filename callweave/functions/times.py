"""Dates, times and zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_hour(ts: Column) -> Column:
    """Start of the 15-minute slot."""
    return slot_start(ts, 900)


def slot_start(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def to_local(ts: Column, zone: Column | str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def between_zones(ts: Column, source: Column | str, target: Column | str) -> Column:
    """Local time of one zone to local time of another."""
    return F.from_utc_timestamp(F.to_utc_timestamp(ts, source), target)


def exists_in_zone(local: Column, zone: Column | str) -> Column:
    """False for a wall-clock time skipped by a clock change."""
    return F.from_utc_timestamp(F.to_utc_timestamp(local, zone), zone) == local


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def shifted(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("long") * 1_000_000)


def backdated(ts: Column, millis: Column) -> Column:
    """Start of an event that is recorded when it ends."""
    return F.timestamp_millis(F.unix_millis(ts) - millis)


def parse_any(text: Column, formats: Sequence[str]) -> Column:
    """First format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def zulu(text: Column, offset_seconds: Column) -> Column:
    """``...Z`` text plus an offset."""
    return shifted(F.to_timestamp(F.regexp_replace(text, "Z$", "")), offset_seconds)


# fixed value: how the survey tool writes "no date"
NO_DATE = "-0001-11-30 00:00:00"


def without_sentinel(text: Column) -> Column:
    return F.nullif(text, F.lit(NO_DATE)).cast("timestamp")


def token_time(token: Column) -> Column:
    """Time at the front of a ``yyyyMMddHHmmss_name`` token, null without one."""
    digits = F.nullif(F.regexp_extract(token, "^(\\d{14})_", 1), F.lit(""))
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))


def token_name(token: Column) -> Column:
    return F.regexp_replace(token, "^\\d{14}_", "")


def clock_seconds(text: Column) -> Column:
    """``HH:mm:ss`` duration text to seconds; hours may exceed 24."""
    part = F.split(text, ":")
    h, m, s = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    return h * 3600 + m * 60 + s


def overnight(login: Column, logout: Column) -> Column:
    """Logout moved to the next day when it lies before the login."""
    return F.when(logout < login, logout + F.expr("interval 1 day")).otherwise(logout)


def hour_label(ts: Column) -> Column:
    """``HH:00:00 - HH:00:00``; the last hour of the day ends at 24."""
    h = F.hour(ts)
    return F.concat(
        F.lpad(h.cast("string"), 2, "0"), F.lit(":00:00 - "), F.lpad((h + 1).cast("string"), 2, "0"), F.lit(":00:00")
    )


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end."""
    return F.timestamp_diff("MINUTE", start, end)

"""Event times, hour buckets and peak hours. Everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: accepted event time text.
ISO_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?Z*$"


def parse_event_ts(text: Column) -> Column:
    """ISO date and time with optional fraction and ``Z``; null if malformed."""
    bare = F.rtrim(text, F.lit("Z"))
    return F.when(text.rlike(ISO_PATTERN), F.concat(bare, F.lit("Z")).try_cast("timestamp"))


def iso_utc(ts: Column) -> Column:
    """``2025-04-16T10:40:00+00:00``; microseconds appear only if not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.unix_micros(ts)
    part = F.pmod(micros, F.lit(1000000))
    fraction = F.when(part == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0")))
    return F.concat(whole, fraction, F.lit("+00:00"))


def normalize_event_time(epoch: Column, text: Column, now: Column | None = None) -> Column:
    """One text form for an event time that came as epoch seconds or as text."""
    fallback = F.current_timestamp() if now is None else now
    return F.coalesce(iso_utc(F.timestamp_seconds(epoch)), text, iso_utc(fallback))


def hour_bucket(date: Column, hour: Column) -> Column:
    return F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T"),
                    F.lpad(hour.cast("string"), 2, "0"))


def duration_min(start: Column, end: Column) -> Column:
    """Whole minutes from start to end."""
    return F.timestamp_diff("MINUTE", start, end)


def is_peak_hour(hour: Column) -> Column:
    return hour.between(7, 10) | hour.between(17, 20)


def in_service_hours(hour: Column) -> Column:
    return hour.between(7, 22)


def latency_ms(started: Column, event_ts: Column) -> Column:
    """Milliseconds from the event to ``started``; 0 when the event time is unknown."""
    gap = (F.unix_micros(started) - F.unix_micros(event_ts)) / F.lit(1000.0)
    return F.coalesce(gap, F.lit(0.0))


def trigger_seconds(window_seconds: Column) -> Column:
    return F.least(window_seconds, F.lit(5))

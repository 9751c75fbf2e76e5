"""Dates. Stored times are zone-less and mean UTC; reports show Paris time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPORT_ZONE = "Europe/Paris"


def to_report_zone(ts: Column, zone: str = REPORT_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def floor_hour(ts: Column) -> Column:
    """Start of the hour, without a detour through the session's time zone."""
    return ts - F.make_dt_interval(
        mins=F.minute(ts), secs=F.date_part(F.lit("SECOND"), ts).cast("decimal(18,6)"))


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def millis_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes with one decimal, null when the run has no length."""
    span = F.timestamp_diff("MICROSECOND", start, end)
    return F.when(span > 0, F.round(span / 60e6, 1).cast("double"))


def millis_duration_minutes(start_ms: Column, end_ms: Column) -> Column:
    span = F.coalesce(end_ms, F.lit(0)) - F.coalesce(start_ms, F.lit(0))
    return F.when(span > 0, F.round(span / 60000.0, 1).cast("double"))

"""Scalar expressions used by the load operators. All of them are plain Catalyst expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_null(data_type: T.DataType | str) -> Column:
    return F.lit(None).cast(data_type)


def or_default(value: Column, default: Column, data_type: T.DataType | str) -> Column:
    """The value, or the default in the value's type where it is null."""
    return F.coalesce(value, default.cast(data_type))


def date_key(moment: Column) -> Column:
    """yyyy-MM-dd text of a date or datetime; null stays null.

    Casting is used instead of date_format because the latter goes through the session time zone.
    """
    return moment.cast("date").cast("string")


def time_key(moment: Column) -> Column:
    """HH:mm:ss text of a datetime, cut (not rounded) to seconds; null stays null."""
    return F.substring(moment.cast("timestamp_ntz").cast("string"), 12, 8)


def moment(value: str | dt.datetime | Column) -> Column:
    """A point in time without zone, given as text, datetime or column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def closing_ts(valid_from: Column) -> Column:
    """End of the version that precedes one starting at valid_from."""
    return valid_from - F.expr("INTERVAL 1 SECOND")


def whole_seconds(now: dt.datetime | None = None) -> dt.datetime:
    """A clock reading rounded to whole seconds, for callers that pass no load time."""
    now = now or dt.datetime.now()
    return (now + dt.timedelta(milliseconds=500)).replace(microsecond=0)


def composite_bk(*parts: Column, sep: str = "|") -> Column:
    """Business key from its parts; a missing part shows as '-1' instead of vanishing."""
    texts = [F.coalesce(p.cast("string"), F.lit("-1")) for p in parts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit(sep), text]
    return F.concat(*joined)


def padded_id(value: Column, width: int = 10) -> Column:
    """Zero-padded id; ids that are already longer stay whole."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def length_of_stay(start: Column, end: Column) -> Column:
    """Days from admission to discharge, the arrival day counted as a full day."""
    return F.datediff(end, start) + F.lit(1)


def duration(unit: str, start: Column, end: Column) -> Column:
    """Whole seconds, minutes, hours or days between two points in time (cut towards zero)."""
    if unit.lower() not in ("second", "minute", "hour", "day"):
        raise ValueError(f"unsupported unit {unit!r}")
    # A difference of zone-less times, so that no daylight-saving shift enters
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return span.cast(f"interval {unit.lower()}").cast("bigint")


def planned_vs_actual(unit: str, planned: Column, actual: Column) -> Column:
    """How much later (positive) or earlier (negative) than planned, in whole units."""
    return duration(unit, planned, actual)

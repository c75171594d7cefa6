"""Calendar and duration expressions over zone-free timestamps.

All of them work on the wall-clock fields of ``timestamp_ntz``. ``date_trunc`` and
``timestampdiff`` would first convert to the session time zone, which costs time
and shifts values inside a daylight-saving gap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | dt.datetime | str | None

# Weekday labels by day number, 1 = Sunday.
WEEKDAY_LABELS = {1: "일", 2: "월", 3: "화", 4: "수", 5: "목", 6: "금", 7: "토"}

# Duration bands as (exclusive upper bound in minutes, label).
DURATION_BANDS = (
    (30, "00~30분"),
    (60, "30~60분"),
    (120, "1~2시간"),
    (240, "2~4시간"),
    (1440, "4~24시간"),
)
LONGEST_BAND = "24시간 이상"


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def as_of_column(as_of: AsOf = None) -> Column:
    """The instant open incidents are measured to; now unless given."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def second_number(ts: Column) -> Column:
    """Whole wall-clock seconds since 1970-01-01, rounded down."""
    # The direct function is much cheaper but rounds towards 1970.
    fields = (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )
    return F.when(ts >= _epoch(), F.unix_timestamp(ts)).otherwise(fields)


def minute_number(ts: Column) -> Column:
    """Whole wall-clock minutes since 1970-01-01, rounded down."""
    return F.floor(second_number(ts) / 60)


def hour_number(ts: Column) -> Column:
    """Whole wall-clock hours since 1970-01-01, rounded down."""
    return F.floor(second_number(ts) / 3600)


def hour_of_number(number: Column) -> Column:
    """The timestamp at which an hour number starts."""
    return _epoch() + F.make_dt_interval(hours=number.cast("int"))


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (09:00:59 to 09:01:00 is 1)."""
    return minute_number(end) - minute_number(start)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``."""
    return second_number(end) - second_number(start)


def incident_minutes(start: Column, end: Column, as_of: AsOf = None) -> Column:
    """Duration in minutes; an incident without an end runs until ``as_of``."""
    return minutes_between(start, F.coalesce(end, as_of_column(as_of)))


def absolute_seconds(start: Column, end: Column) -> Column:
    """Unsigned duration in seconds; null while the incident is open."""
    return F.abs(seconds_between(start, end))


def hour_start(ts: Column) -> Column:
    """The timestamp truncated to its hour."""
    return hour_of_number(hour_number(ts))


def weekday_label(day_number: Column) -> Column:
    """Label of a day number (1 = Sunday); null for anything else."""
    pairs = [F.lit(x) for item in WEEKDAY_LABELS.items() for x in item]
    return F.element_at(F.create_map(*pairs), day_number)


def duration_band(minutes: Column) -> Column:
    """Band of a duration. Negative falls in the first band, null in the last."""
    bands = [F.when(minutes < upper, label) for upper, label in DURATION_BANDS]
    return F.coalesce(*bands, F.lit(LONGEST_BAND))

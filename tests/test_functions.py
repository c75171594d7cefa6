import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadevents.functions import text, times


def value(spark, column, **columns):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return frame.select(column.alias("v")).first().v


def ts(text_value):
    return F.lit(text_value).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "start, end, minutes, seconds",
    [
        ("2024-01-01 09:00:59", "2024-01-01 09:01:00", 1, 1),
        ("2024-01-01 09:00:00", "2024-01-01 09:00:59", 0, 59),
        ("2024-01-01 09:00:15.9", "2024-01-01 09:00:16.1", 0, 1),
        ("2023-12-31 23:59:59.999", "2024-01-01 00:00:00", 1, 1),
        ("2024-01-01 09:05:00", "2024-01-01 09:00:00", -5, -300),
        ("1969-12-31 23:59:30", "1970-01-01 00:00:30", 1, 60),
        ("1969-12-31 23:58:59.5", "1969-12-31 23:59:00.5", 1, 1),
        ("2024-02-28 00:00:00", "2024-03-01 00:00:00", 2880, 172800),
    ],
)
def test_boundaries_are_counted(spark, start, end, minutes, seconds):
    assert value(spark, times.minutes_between(ts(start), ts(end))) == minutes
    assert value(spark, times.seconds_between(ts(start), ts(end))) == seconds
    assert value(spark, times.absolute_seconds(ts(start), ts(end))) == abs(seconds)


def test_open_incident_runs_to_as_of(spark):
    start, end = ts("2024-01-01 00:00:00"), F.lit(None).cast("timestamp_ntz")
    for as_of in (
        "2024-01-01 01:00:00",
        dt.datetime(2024, 1, 1, 1),
        ts("2024-01-01 01:00:00"),
    ):
        assert value(spark, times.incident_minutes(start, end, as_of)) == 60
    assert value(spark, times.absolute_seconds(start, end)) is None
    assert value(spark, times.incident_minutes(end, start, None)) is None
    assert value(spark, times.incident_minutes(start, end)) > 1_000_000


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_time_functions_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        gap = ts("2024-03-10 02:30:15")  # does not exist in New York
        assert value(spark, times.hour_start(gap)) == dt.datetime(2024, 3, 10, 2)
        before_epoch = times.hour_start(ts("1969-12-31 22:59:59.9"))
        assert value(spark, before_epoch) == dt.datetime(1969, 12, 31, 22)
        hours = times.minutes_between(ts("2024-03-10 01:30:00"), ts("2024-03-10 03:30:00"))
        assert value(spark, hours) == 120
        assert value(spark, text.to_timestamp14(F.lit("20240310023015"))) == dt.datetime(
            2024, 3, 10, 2, 30, 15
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "minutes, band",
    [
        (-5, "00~30분"), (0, "00~30분"), (29, "00~30분"), (30, "30~60분"),
        (59, "30~60분"), (60, "1~2시간"), (119, "1~2시간"), (120, "2~4시간"),
        (239, "2~4시간"), (240, "4~24시간"), (1439, "4~24시간"),
        (1440, "24시간 이상"), (None, "24시간 이상"),
    ],
)
def test_duration_band(spark, minutes, band):
    assert value(spark, times.duration_band(F.lit(minutes).cast("bigint"))) == band


def test_weekday_label(spark):
    sunday = F.dayofweek(F.lit("2025-11-16").cast("date"))
    assert value(spark, times.weekday_label(sunday)) == "일"
    labels = [value(spark, times.weekday_label(F.lit(n))) for n in range(1, 8)]
    assert labels == ["일", "월", "화", "수", "목", "금", "토"]
    assert value(spark, times.weekday_label(F.lit(8))) is None
    assert value(spark, times.weekday_label(F.lit(None).cast("int"))) is None


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("126.5", 126.5), ("-1e3", -1000.0), (" 7 ", 7.0), (".5", 0.5), ("abc", None),
        ("nan", None), ("Infinity", None), ("1d", None), ("1f", None), ("", None),
        ("1.2.3", None), (None, None),
    ],
)
def test_to_double(spark, raw, expected):
    assert value(spark, text.to_double(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("110", 110), ("110.0", 110), ("110.5", 111), ("-110.5", -111),
        ("0.49999999", 0), ("9007199254740993", 9007199254740993),
        ("9007199254740993.0", 9007199254740993), ("1.1E2", 110), ("abc", None),
        ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None),
        ("", None), (None, None),
    ],
)
def test_to_long(spark, raw, expected):
    assert value(spark, text.to_long(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("20251116083000", dt.datetime(2025, 11, 16, 8, 30)),
        ("20251399000000", None), ("20250230000000", None), ("20251116246000", None),
        ("20251116083060", None), ("2025111608300", None), ("202511160830001", None),
        (" 0251116083000", None), ("2025111608300 ", None), ("+2025111608300", None),
        ("", None), (None, None),
    ],
)
def test_to_timestamp14(spark, raw, expected):
    assert value(spark, text.to_timestamp14(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "raw, date, hour",
    [
        ("20251116083000", dt.date(2025, 11, 16), 8),
        ("2025-11-16 08:30:00.5", dt.date(2025, 11, 16), 8),
        ("2025111699", dt.date(2025, 11, 16), 99),
        ("20251116", dt.date(2025, 11, 16), None),
        ("2025111", None, None), ("20251399083000", None, 8), ("", None, None),
    ],
)
def test_leading_date_and_hour(spark, raw, date, hour):
    digits = text.digits(F.lit(raw))
    assert value(spark, text.leading_date(digits)) == date
    assert value(spark, text.leading_hour(digits)) == hour


def test_null_if_matches_exactly(spark):
    kept = [value(spark, text.null_if(F.lit(t), ("-", "NULL"))) for t in ("-", " -", "null")]
    assert kept == [None, " -", "null"]
    assert value(spark, text.null_if(F.lit("-"), ())) == "-"


def test_not_blank(spark):
    cases = {"x": True, " ": False, "": False, None: False}
    for case, expected in cases.items():
        assert value(spark, text.not_blank(F.lit(case).cast("string"))) is expected
    assert value(spark, text.not_blank(ts("2024-01-01 00:00:00"))) is True


def test_joined_key_and_stringify(spark):
    assert value(spark, text.joined_key(F.lit("a"), F.lit(1))) == "a_1"
    assert value(spark, text.joined_key(F.lit(None).cast("string"), F.lit(1))) == "_1"
    frame = spark.sql("select 1 a, cast(null as int) b, 1.5D c")
    assert text.stringify(frame).collect() == [("1", None, "1.5")]
    assert {t for _, t in text.stringify(frame).dtypes} == {"string"}


def test_durations_of_random_pairs(spark):
    random.seed(7)
    low, high = dt.datetime(1960, 1, 1), dt.datetime(2040, 1, 1)
    span = int((high - low).total_seconds() * 1e6)
    pairs = [
        tuple(low + dt.timedelta(microseconds=random.randrange(span)) for _ in "ab")
        for _ in range(2000)
    ]
    start, end = F.col("start"), F.col("end")
    rows = spark.createDataFrame(pairs, "start timestamp_ntz, end timestamp_ntz").select(
        "start",
        "end",
        times.minutes_between(start, end).alias("minutes"),
        times.seconds_between(start, end).alias("seconds"),
        times.hour_start(start).alias("hour"),
    )
    for row in rows.collect():
        clipped = [t.replace(second=0, microsecond=0) for t in (row.start, row.end)]
        assert row.minutes == (clipped[1] - clipped[0]) / dt.timedelta(minutes=1)
        clipped = [t.replace(microsecond=0) for t in (row.start, row.end)]
        assert row.seconds == (clipped[1] - clipped[0]).total_seconds()
        assert row.hour == row.start.replace(minute=0, second=0, microsecond=0)

"""The reporting tables, one function each.

Every function takes the typed event table and returns an unevaluated DataFrame.
``as_of`` is the instant open incidents are measured to (default: now).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadevents.functions import text, times
from roadevents.operators.ordering import ascending, descending

PLACES = 6


def _minutes(as_of: times.AsOf) -> Column:
    return times.incident_minutes(F.col("startDate"), F.col("endDate"), as_of)


def _average(value: Column) -> Column:
    return F.round(F.avg(value), PLACES)


def src_events(events: DataFrame, **_) -> DataFrame:
    """The event table as it is."""
    return events.select("*")


def stg_event_info(events: DataFrame, **_) -> DataFrame:
    """Staging projection."""
    return events.select(
        "eventType", "eventDetailType", "startDate", "endDate", "coordX", "coordY"
    )


def event_type_summary(events: DataFrame, **_) -> DataFrame:
    """Count and share per event type."""
    counts = events.groupBy("eventType").agg(F.count("*").alias("event_count"))
    # The unpartitioned window runs over one row per event type.
    total = F.sum("event_count").over(Window.partitionBy())
    share = F.round(F.col("event_count") * F.lit(100).cast("decimal(4,1)") / total, 2)
    return counts.withColumn("percentage", share.cast("double")).orderBy(
        *descending("event_count"), *ascending("eventType")
    )


def events_by_road_type(
    events: DataFrame, *, approximate: bool = False, **_
) -> DataFrame:
    """Events, roads, active days and links per road type.

    Exact by default: distinct values are collapsed per task before they move, so a
    road type with most of the rows is spread over its own values.
    ``approximate=True`` replaces the exact counts with sketches.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        events.where(F.col("type").isNotNull())
        .groupBy(F.col("type").alias("road_type"))
        .agg(
            F.count("*").alias("total_events"),
            distinct(F.col("roadName")).alias("total_roads"),
            distinct(F.to_date("startDate")).alias("active_days"),
            distinct(F.col("linkId")).alias("unique_locations"),
        )
        .orderBy(*descending("total_events"), *ascending("road_type"))
    )


def daily_event_count(events: DataFrame, **_) -> DataFrame:
    """Events per start date; events without a start form a null day."""
    return (
        events.groupBy(F.to_date("startDate").alias("event_date"))
        .agg(F.count("*").alias("event_count"))
        .orderBy(*ascending("event_date"))
    )


def hourly_event_heatmap(events: DataFrame, **_) -> DataFrame:
    """Events per weekday and hour. ``startDate`` may be a timestamp or digit text."""
    is_text = dict(events.dtypes)["startDate"] == "string"
    present = text.not_blank(F.col("startDate")) if is_text else F.col("startDate").isNotNull()
    starts = events.select("startDate").where(present)
    if is_text:
        starts = starts.select(text.digits(F.col("startDate")).alias("digits"))
        date = text.leading_date(F.col("digits"))
        hour = text.leading_hour(F.col("digits"))
    else:
        date, hour = F.to_date("startDate"), F.hour("startDate")
    counts = starts.groupBy(
        F.dayofweek(date).alias("weekday_order"), hour.alias("hour")
    ).agg(F.count("*").alias("event_count"))
    return counts.select(
        times.weekday_label(F.col("weekday_order")).alias("weekday"),
        "hour",
        "event_count",
        "weekday_order",
    ).orderBy(*ascending("weekday_order", "hour"))


def weekday_event_count(events: DataFrame, **_) -> DataFrame:
    """Events per weekday, 1 = Sunday."""
    counts = (
        events.where(F.col("startDate").isNotNull())
        .groupBy(F.dayofweek(F.to_date("startDate")).alias("weekday_num"))
        .agg(F.count("*").alias("event_count"))
    )
    # 1970-01-04 was a Sunday; naming the seven groups is cheaper than every row.
    sample_day = F.date_add(F.lit("1970-01-03").cast("date"), F.col("weekday_num"))
    return counts.select(
        F.dayname(sample_day).alias("weekday_short"), "weekday_num", "event_count"
    ).orderBy(*ascending("weekday_num"))


def avg_duration_by_type(
    events: DataFrame, *, as_of: times.AsOf = None, **_
) -> DataFrame:
    """Count and mean minutes per road type and event type."""
    return (
        events.groupBy("type", "eventType")
        .agg(
            F.count("*").alias("total_cnt"),
            _average(_minutes(as_of)).alias("avg_duration_min"),
        )
        .orderBy(*descending("avg_duration_min"), *ascending("type", "eventType"))
    )


def avg_duration_by_hour(
    events: DataFrame, *, as_of: times.AsOf = None, **_
) -> DataFrame:
    """Mean minutes per hour of start."""
    means = events.groupBy(times.hour_number(F.col("startDate")).alias("hour")).agg(
        _average(_minutes(as_of)).alias("avg_duration_min")
    )
    return means.select(
        times.hour_of_number(F.col("hour")).alias("hour_block"), "avg_duration_min"
    ).orderBy(*ascending("hour_block"))


def avg_duration_hours_by_road_type(events: DataFrame, **_) -> DataFrame:
    """Mean unsigned hours per road type; open incidents do not count."""
    start, end = (F.col(c).cast("timestamp_ntz") for c in ("startDate", "endDate"))
    # Whole seconds are averaged first: the sum is then exact in any order.
    hours = F.round(F.avg(times.absolute_seconds(start, end)) / 3600.0, PLACES)
    return (
        events.where(F.col("type").isNotNull())
        .groupBy(F.col("type").alias("road_type"))
        .agg(hours.alias("average_duration_hours"))
        .orderBy(*descending("average_duration_hours"), *ascending("road_type"))
    )


def duration_buckets(events: DataFrame, *, as_of: times.AsOf = None, **_) -> DataFrame:
    """Events per duration band."""
    return (
        events.withColumn("duration_min", _minutes(as_of))
        .groupBy(times.duration_band(F.col("duration_min")).alias("duration_range"))
        .agg(F.count("*").alias("event_count"))
        .orderBy(*descending("event_count"), *ascending("duration_range"))
    )


def event_type_duration_stats(
    events: DataFrame, *, as_of: times.AsOf = None, **_
) -> DataFrame:
    """Count and mean, least and greatest minutes per event type."""
    timed = events.select("eventType", _minutes(as_of).alias("minutes"))
    return (
        timed.groupBy("eventType")
        .agg(
            F.count("*").alias("event_count"),
            _average(F.col("minutes")).alias("avg_duration_min"),
            F.min("minutes").alias("min_duration_min"),
            F.max("minutes").alias("max_duration_min"),
        )
        .orderBy(*descending("avg_duration_min"), *ascending("eventType"))
    )


def event_durations(events: DataFrame, *, as_of: times.AsOf = None, **_) -> DataFrame:
    """Minutes per event."""
    return events.select(
        "type",
        "eventType",
        "eventDetailType",
        "startDate",
        "endDate",
        _minutes(as_of).alias("duration_minutes"),
    )

"""Nine reporting tables from one pass over the events.

Building them one by one scans the event table once each. Here the events are first
reduced to one row per road type, event type, start hour and duration band; that
table is small however many events there are, and the reports regroup it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadevents.functions import times
from roadevents.operators.ordering import ascending, descending
from roadevents.plans.marts import PLACES
from roadevents.sinks.files import full_refresh


def hourly_rollup(events: DataFrame, *, as_of: times.AsOf = None) -> DataFrame:
    """Counts and duration sums at the finest grain the reports need."""
    start, end = F.col("startDate"), F.col("endDate")
    measured = events.select(
        "type",
        "eventType",
        times.hour_number(start).alias("hour_number"),
        times.incident_minutes(start, end, as_of).alias("minutes"),
        times.absolute_seconds(start, end).alias("seconds"),
    )
    grouped = measured.groupBy(
        "type",
        "eventType",
        "hour_number",
        times.duration_band(F.col("minutes")).alias("duration_range"),
    ).agg(
        F.count("*").alias("events"),
        F.sum("minutes").alias("minutes"),
        F.count("minutes").alias("timed"),
        F.min("minutes").alias("least_minutes"),
        F.max("minutes").alias("most_minutes"),
        F.sum("seconds").alias("seconds"),
        F.count("seconds").alias("closed"),
    )
    hour_block = times.hour_of_number(F.col("hour_number"))
    return grouped.withColumn("hour_block", hour_block).drop("hour_number")


def _events(name: str) -> Column:
    return F.sum("events").alias(name)


def _mean_minutes() -> Column:
    mean = F.try_divide(F.sum("minutes"), F.sum("timed"))
    return F.round(mean, PLACES).alias("avg_duration_min")


def reports(rollup: DataFrame) -> dict[str, DataFrame]:
    """The reports by name, each equal to its function in ``marts``."""
    rollup = rollup.withColumns(
        {"day": F.to_date("hour_block"), "hour": F.hour("hour_block")}
    )
    dated = rollup.where(F.col("day").isNotNull())
    weekday = F.dayofweek("day")
    per_event_type = rollup.groupBy("eventType").agg(_events("event_count"))
    total = F.sum("event_count").over(Window.partitionBy())
    share = F.round(F.col("event_count") * F.lit(100).cast("decimal(4,1)") / total, 2)
    hours = F.try_divide(F.sum("seconds"), F.sum("closed")) / 3600.0
    return {
        "event_type_summary": per_event_type.withColumn(
            "percentage", share.cast("double")
        ).orderBy(*descending("event_count"), *ascending("eventType")),
        "daily_event_count": rollup.groupBy(F.col("day").alias("event_date"))
        .agg(_events("event_count"))
        .orderBy(*ascending("event_date")),
        "hourly_event_heatmap": dated.groupBy(weekday.alias("weekday_order"), "hour")
        .agg(_events("event_count"))
        .select(
            times.weekday_label(F.col("weekday_order")).alias("weekday"),
            "hour",
            "event_count",
            "weekday_order",
        )
        .orderBy(*ascending("weekday_order", "hour")),
        "weekday_event_count": dated.groupBy(
            F.dayname("day").alias("weekday_short"), weekday.alias("weekday_num")
        )
        .agg(_events("event_count"))
        .orderBy(*ascending("weekday_num")),
        "avg_duration_by_type": rollup.groupBy("type", "eventType")
        .agg(_events("total_cnt"), _mean_minutes())
        .orderBy(*descending("avg_duration_min"), *ascending("type", "eventType")),
        "avg_duration_by_hour": rollup.groupBy("hour_block")
        .agg(_mean_minutes())
        .orderBy(*ascending("hour_block")),
        "avg_duration_hours_by_road_type": rollup.where(F.col("type").isNotNull())
        .groupBy(F.col("type").alias("road_type"))
        .agg(F.round(hours, PLACES).alias("average_duration_hours"))
        .orderBy(*descending("average_duration_hours"), *ascending("road_type")),
        "duration_buckets": rollup.groupBy("duration_range")
        .agg(_events("event_count"))
        .orderBy(*descending("event_count"), *ascending("duration_range")),
        "event_type_duration_stats": rollup.groupBy("eventType")
        .agg(
            _events("event_count"),
            _mean_minutes(),
            F.min("least_minutes").alias("min_duration_min"),
            F.max("most_minutes").alias("max_duration_min"),
        )
        .orderBy(*descending("avg_duration_min"), *ascending("eventType")),
    }


def reports_in_one_pass(
    events: DataFrame, path: str, *, as_of: times.AsOf = None
) -> dict[str, DataFrame]:
    """Writes the rollup to ``path``, replacing an earlier one, and returns the reports
    over it. They show the events as they were then; write again to bring them up to date.
    """
    full_refresh(hourly_rollup(events, as_of=as_of), path)
    return reports(events.sparkSession.read.parquet(path))

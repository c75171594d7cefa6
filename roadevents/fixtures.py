"""An incident view over a generic event-stream table, used by the registered queries.

The source has ``event_id, ts, user_id, event_type, value, props``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadevents.schema import FIELDS

AS_OF = "2024-02-01 00:00:00"

# How generic event types and users stand for incident classes.
EVENT_TYPES = {"error": "교통사고", "click": "공사", "view": "기타돌발", "purchase": "기상"}
ROAD_TYPES = {0: "고속도로", 1: "국도", 2: "지방도", 3: "시군도"}


def _choose(value: Column, choices: dict) -> Column:
    picked = [F.when(value == k, v) for k, v in choices.items()]
    return F.coalesce(*picked)


def incident_events(spark: SparkSession, folder: str) -> DataFrame:
    """Typed incidents, one per source event, with ``event_id`` as an extra column."""
    source = spark.read.parquet(f"{folder}/events.parquet")
    user, number = F.col("user_id"), F.col("event_id")
    seconds = F.round(F.col("value") * 60)
    end = F.col("ts") + F.make_dt_interval(secs=seconds)
    return source.select(
        "event_id",
        _choose(user % 5, ROAD_TYPES).alias("type"),
        _choose(F.col("event_type"), EVENT_TYPES).alias("eventType"),
        F.get_json_object("props", "$.k").alias("eventDetailType"),
        F.col("ts").alias("startDate"),
        (F.lit(126.0) + (user % 100) / 100.0).alias("coordX"),
        (F.lit(35.0) + (number % 50) / 50.0).alias("coordY"),
        (user + 1000000000).alias("linkId"),
        F.concat(F.lit("road-"), user % 40).alias("roadName"),
        (user % 300).alias("roadNo"),
        F.when(user % 2 == 0, "기점").otherwise("종점").alias("roadDrcType"),
        F.lit(None).cast("string").alias("lanesBlockType"),
        F.concat(user % 4 + 1, F.lit("차로 차단")).alias("lanesBlocked"),
        F.concat(F.lit('구간 "'), number, F.lit('",\n우회 요망')).alias("message"),
        F.when(F.col("event_type") != "error", end).alias("endDate"),
    )


def _compact(ts: str) -> Column:
    digits = F.regexp_replace(F.col(ts).cast("string"), "[^0-9]", "")
    return F.substring(digits, 1, 14)


def as_text(events: DataFrame) -> DataFrame:
    """The events as landed: all text, dates as ``yyyyMMddHHmmss``; same ``event_id``."""
    return events.withColumns(
        {
            **{c: F.col(c).cast("string") for c in ("coordX", "coordY", "linkId", "roadNo")},
            **{c: _compact(c) for c in ("startDate", "endDate")},
        }
    )


def dirty_text(events: DataFrame) -> DataFrame:
    """``as_text`` with missing-value markers, ``.0`` integers and bad values."""
    n = F.col("event_id")
    coord = F.when(n % 10 == 0, "-").when(n % 10 == 1, "").when(n % 23 == 0, "abc")
    link = (
        F.when(n % 17 == 0, "NULL")
        .when(n % 5 == 0, F.concat("linkId", F.lit(".0")))
        .when(n % 29 == 0, F.concat(F.lit("L"), "linkId"))
    )
    start = F.when(n % 31 == 0, F.substring("startDate", 1, 7))
    end = F.when(n % 37 == 0, "20241399000000").when(n % 7 == 0, "")
    return as_text(events).withColumns(
        {
            "coordX": coord.otherwise(F.col("coordX")),
            "linkId": link.otherwise(F.col("linkId")),
            "startDate": start.otherwise(F.col("startDate")),
            "endDate": end.otherwise(F.col("endDate")),
        }
    )


def fields_with(events: DataFrame, *extra: str) -> DataFrame:
    """The record's fields in file order, after the named extra columns."""
    return events.select(*extra, *FIELDS)

"""Rollups that follow their events: only the days that a batch has touched are aggregated
again, and distinct counts merge from sketches of each day.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.functions.times import AsOf
from roadevents.operators.ordering import ascending, descending
from roadevents.plans.rollup import hourly_rollup, reports
from roadevents.schema import EVENT_SCHEMA
from roadevents.session import path_has_files
from roadevents.sinks.upsert import DAY

# Of each sketch: 2^12 registers, with a relative standard error of 1.04 / 2^6.
LG_REGISTERS = 12
STANDARD_ERROR = 1.04 / math.sqrt(1 << LG_REGISTERS)
# What is counted distinctly per road type, and the report's name for it.
DISTINCT = {"roadName": "total_roads", "linkId": "unique_locations"}


def append_events(events: DataFrame, path: str) -> None:
    """Adds events to a table of day folders."""
    with_day = events.withColumn(DAY, F.to_date("startDate"))
    with_day.hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(path)


def _days(rows: DataFrame, day: Column) -> Column:
    """The condition for the days of the rows: a value for each day of the calendar there."""
    found = [r["day"] for r in rows.select(day.alias("day")).distinct().collect()]
    touched = F.col(DAY).isin([d for d in found if d is not None])
    return touched | F.col(DAY).isNull() if None in found else touched


def _replace(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    if not path_has_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def refresh_rollup(
    batch: DataFrame,
    events: str,
    rollup: str,
    *,
    as_of: AsOf = None,
    sketches: str | None = None,
    schema: T.StructType = EVENT_SCHEMA,
) -> None:
    """Brings the rollup, and the ``sketches`` of distinct values, up to date with a batch
    that has been added to ``events``, a table of day folders.

    The batch's days are read from the events and replaced in the rollup; other days are
    neither read nor written. Doing it again changes nothing, so a run that failed is
    repeated. Events that are open are measured to ``as_of``, those of other days to the
    time of their last refresh.
    """
    spark = batch.sparkSession
    touched = _days(batch, F.to_date("startDate"))
    stored = _stored(spark, events, schema).where(touched)
    rows = hourly_rollup(stored, as_of=as_of)
    _replace(rows.withColumn(DAY, F.to_date("hour_block")), rollup)
    if sketches:
        _replace(day_sketches(stored), sketches)


def current_reports(spark: SparkSession, rollup: str) -> dict[str, DataFrame]:
    """The nine reports over a rollup that ``refresh_rollup`` keeps."""
    return reports(spark.read.parquet(rollup).drop(DAY))


def day_sketches(events: DataFrame) -> DataFrame:
    """Per road type and day the events and a sketch of each distinctly counted column.

    A sketch has at most some kilobytes, however many events the day has.
    """
    kept = [F.hll_sketch_agg(F.col(c).cast("string"), LG_REGISTERS).alias(c) for c in DISTINCT]
    typed = events.where(F.col("type").isNotNull())
    by = [F.col("type"), F.to_date("startDate").alias(DAY)]
    return typed.groupBy(*by).agg(F.count("*").alias("events"), *kept)


def events_by_road_type_estimated(sketches: DataFrame) -> DataFrame:
    """``events_by_road_type`` from stored day sketches: events and active days exactly,
    roads and links as estimates with a relative standard error of 1.6 percent."""
    unions = [
        F.hll_sketch_estimate(F.hll_union_agg(c)).alias(name) for c, name in DISTINCT.items()
    ]
    counted = sketches.groupBy(F.col("type").alias("road_type")).agg(
        F.sum("events").alias("total_events"), F.count_distinct(DAY).alias("active_days"), *unions
    )
    columns = ["road_type", "total_events", "total_roads", "active_days", "unique_locations"]
    return counted.select(*columns).orderBy(*descending("total_events"), *ascending("road_type"))

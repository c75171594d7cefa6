"""Scans of stored tables and of one partition of a landing area."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table or view by name, or a Parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def in_partition(
    df: DataFrame, day: dt.date | str, column: str = "ingestion_date"
) -> DataFrame:
    """Only the folder of one day; Spark skips the other folders when listing files."""
    return df.where(F.col(column) == F.lit(str(day)).cast("date"))

"""Parquet files of text columns, bound by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadevents.operators.normalize import apply_null_markers
from roadevents.schema import FIELDS


def parquet_by_name(
    spark: SparkSession,
    path: str,
    fields: Sequence[str] = FIELDS,
    *,
    missing_text: Sequence[str] = (),
) -> DataFrame:
    """``fields`` by name; other columns are dropped, absent ones null.

    Only ``*.parquet`` files are read, as the folder may also hold the original CSV.
    Partition folders become columns. ``missing_text`` lists text that stands for a
    missing value in files written by a tool that stringified it.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    df = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)
    return apply_null_markers(df, missing_text) if missing_text else df

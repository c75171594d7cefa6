"""Landing and table writes to folders."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.operators.dedup import dedup_first, with_unique_id
from roadevents.session import move, path_has_files, remove

PARTITION = "ingestion_date"
# A landed file is read by several tasks: each reads whole row groups.
ROW_GROUP_BYTES = 16 << 20


def _by_day(df: DataFrame, day: dt.date | str | None, mode: str):
    """A writer of day folders; overwriting replaces only the days being written.

    Rows are rebalanced by day first: a small day is one file however many tasks have
    rows of it, and a large one is split.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    if day is not None:
        df = df.withColumn(PARTITION, F.lit(str(day)).cast("date"))
    return (
        df.hint("rebalance", PARTITION)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
    )


def land_csv(
    df: DataFrame, path: str, day: dt.date | str | None = None, *, mode: str = "overwrite"
) -> None:
    """CSV with a header under ``path/ingestion_date=day``.

    ``day`` is used for all rows; without it the frame has the column.
    ``mode="append"`` keeps earlier polls of the day.
    """
    (
        _by_day(df, day, mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def land_parquet(
    df: DataFrame, path: str, day: dt.date | str | None = None, *, mode: str = "overwrite"
) -> None:
    """Parquet under ``path/ingestion_date=day``."""
    _by_day(df, day, mode).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def land_deduplicated(
    df: DataFrame, path: str, day: dt.date | str, order: Sequence[str] = ("seq",)
) -> None:
    """First record per key and its ``unique_id`` as Parquet, replacing the day.

    The ``order`` columns are not stored.
    """
    first = with_unique_id(dedup_first(df, order=order))
    land_parquet(first.drop(*order), path, day)


def create_if_absent(
    spark: SparkSession, path: str, schema: T.StructType, *partition_by: str
) -> None:
    """An empty table with the schema, unless the folder already holds something."""
    if not path_has_files(spark, path):
        empty = spark.createDataFrame([], schema)
        empty.write.partitionBy(*partition_by).parquet(path)


def append_load(df: DataFrame, path: str) -> None:
    """Adds the rows; repeated snapshots of an open incident accumulate."""
    df.write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replaces the table by ``df``, which may read from it.

    The new rows are written beside the table and take its place when they are complete,
    so a load that fails leaves the table as it was.
    """
    fresh, old = (f"{path.rstrip('/')}-{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    try:
        df.write.parquet(fresh)
    except Exception:
        remove(df.sparkSession, fresh)
        raise
    if move(df.sparkSession, path, old):
        move(df.sparkSession, fresh, path)
        remove(df.sparkSession, old)
    else:
        move(df.sparkSession, fresh, path)

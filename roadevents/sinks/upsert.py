"""Keeping a stored table current with batches.

The table is Parquet in one folder per start day. Both write policies have the start
in their key, so a batch can only touch its own days: those folders are read, and
only those are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.functions.text import digits, leading_date
from roadevents.operators.dedup import snapshot_latest
from roadevents.operators.merge import (
    merge_upsert,
    require_unique_keys,
    without_late,
    without_replayed,
)
from roadevents.schema import (
    CENTRAL_SCHEMA,
    LATEST_KEYS,
    MERGE_KEYS,
    MERGE_SCHEMA,
)
from roadevents.session import path_has_files

DAY = "start_day"


def start_day(df: DataFrame) -> Column:
    """The folder of a row. Start text that is no date goes to the null folder."""
    start = F.col("startDate")
    if dict(df.dtypes)["startDate"] == "string":
        return leading_date(digits(start))
    return F.to_date(start)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType = MERGE_SCHEMA
) -> DataFrame:
    """The stored table without its folder column."""
    return _stored(spark, path, schema).drop(DAY)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    if not path_has_files(spark, path):
        # Known to be empty when a job is planned: joins with it go, and no task runs.
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(1).select(*nothing).limit(0)
    return spark.read.schema(schema).parquet(path)


def _touched(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored rows in the batch's days.

    Folders outside the batch's span of days are not read; a join leaves out the days
    inside the span that the batch does not have.
    """
    day = F.col(DAY)
    span = batch.agg(
        F.min(day).alias("first"), F.max(day).alias("last"), F.count_if(day.isNull()).alias("none")
    ).first()
    touched = F.lit(False)
    if span["first"] is not None:
        touched = day.between(F.lit(span["first"]), F.lit(span["last"]))
    if span["none"]:
        touched = touched | day.isNull()
    days = batch.select(day.alias("_day")).distinct()
    return stored.where(touched).join(days, day.eqNullSafe(F.col("_day")), "left_semi")


@contextmanager
def _kept(batch: DataFrame):
    """The batch held for several uses; lost blocks are recomputed from its input."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield batch
    finally:
        batch.unpersist()


def _replace_days(rows: DataFrame, path: str) -> None:
    # Rebalancing splits a day that is far larger than the others over several tasks
    # and packs small days together.
    (
        rows.hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def _update(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    if "startDate" not in keys:
        raise ValueError("a stored table is updated by a key that contains startDate")
    spark = batch.sparkSession
    batch = batch.select(*schema.names).withColumn(DAY, start_day(batch))
    with _kept(batch):
        target = _touched(_stored(spark, path, schema), batch)
        _replace_days(combine(target, batch), path)


def merge_into(
    batch: DataFrame,
    path: str,
    *,
    stamp: Column | None = None,
    keys: Sequence[str] = MERGE_KEYS,
    schema: T.StructType = MERGE_SCHEMA,
    unique_target: bool = False,
    checked: bool = False,
    replayable: bool = False,
    recency: Sequence[str] = (),
) -> None:
    """Merges a batch into the stored table; see ``merge_upsert`` for the meaning.

    ``stamp`` (default: now) is written to ``ingestion_timestamp`` of changed rows.
    ``unique_target=True`` is for tables that only ever changed through this function,
    ``checked=True`` for batches known to hold one row per complete key.
    ``replayable=True`` leaves out batch rows without a complete key that the table
    already holds in all columns, stamp included: they come from the same batch. With
    ``recency``, stored columns that order the forms of a row, a batch row that is older
    than the stored one changes nothing.
    """
    if "ingestion_timestamp" in schema.names:
        if stamp is None and "ingestion_timestamp" not in batch.columns:
            stamp = F.localtimestamp()
        if stamp is not None:
            batch = batch.withColumn("ingestion_timestamp", stamp)

    def combine(target: DataFrame, kept: DataFrame) -> DataFrame:
        if not checked:
            require_unique_keys(kept, keys)
        if replayable:
            kept = without_replayed(target, kept, keys)
        if recency:
            kept = without_late(target, kept, keys, recency)
        return merge_upsert(target, kept, keys, unique_target=unique_target)

    _update(batch, path, schema, keys, combine)


def rewrite_latest(
    batch: DataFrame,
    path: str,
    *,
    stamp: Column | None = None,
    keys: Sequence[str] = LATEST_KEYS,
    schema: T.StructType = CENTRAL_SCHEMA,
    recency: Sequence[str] = ("createdAt",),
) -> None:
    """Adds a batch to the stored table and keeps the latest row per key.

    ``stamp`` (default: now) is the batch's ``createdAt``. ``recency`` are the columns
    that order the forms of a row.
    """
    if stamp is None and "createdAt" not in batch.columns:
        stamp = F.current_timestamp()
    if stamp is not None:
        batch = batch.withColumn("createdAt", stamp)
    _update(
        batch,
        path,
        schema,
        keys,
        lambda target, kept: snapshot_latest(
            target, kept, keys, recency[0], recency[1:]
        ),
    )

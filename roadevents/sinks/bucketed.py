"""A catalog table kept by merges that never move it.

The table is partitioned by start day and bucketed by the merge key: a key's rows lie in
one bucket of one day. A merge deals the batch out like the buckets, reads each bucket of
the batch's days beside its part of the batch, and writes it back in place. Only the batch
is shuffled, whatever the table's size.

A key whose parts are all null has one bucket; use ``sinks.upsert.merge_into`` for feeds in
which many records have no key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.operators.merge import require_unique_keys
from roadevents.schema import MERGE_KEYS, MERGE_SCHEMA
from roadevents.sinks.upsert import DAY, start_day

_HIT = "_hit"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_bucketed(
    spark: SparkSession,
    name: str,
    schema: T.StructType = MERGE_SCHEMA,
    keys: Sequence[str] = MERGE_KEYS,
    *,
    buckets: int = 64,
) -> None:
    """An empty table, unless there is one. ``buckets`` should be some times the tasks that
    a merge is to run on; a day has as many files."""
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {DAY} date) USING parquet PARTITIONED BY ({DAY}) "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
    )


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str] = MERGE_KEYS) -> DataFrame:
    """The target after the merge, as one join: rows of the batch in place of those of the
    same key, and both sides' others. Keys with a null part match nothing."""
    fresh = batch.select(*[F.col(c).alias(f"_new_{c}") for c in target.columns], F.lit(True).alias(_HIT))
    same = reduce(and_, [F.col(k) == F.col(f"_new_{k}") for k in keys])
    # As merge joins: both sides are sorted, and the stored one is not collected.
    joined = target.hint("merge").join(fresh.hint("merge"), same, "full_outer")
    return joined.select(
        *[F.when(F.col(_HIT), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns]
    )


def merge_plan(
    batch: DataFrame, name: str, keys: Sequence[str] = MERGE_KEYS
) -> DataFrame:
    """What a merge writes: the batch's days of the table after it."""
    stored = batch.sparkSession.table(name)
    batch = batch.withColumn(DAY, start_day(batch)).select(*stored.columns)
    # One value for each day of the calendar that the batch has; other days are not read.
    days = [r[DAY] for r in batch.select(DAY).distinct().collect()]
    touched = F.col(DAY).isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col(DAY).isNull()
    return merged(stored.where(touched), batch, keys)


def merge_bucketed(
    batch: DataFrame,
    name: str,
    keys: Sequence[str] = MERGE_KEYS,
    *,
    stamp: Column | None = None,
    checked: bool = False,
) -> None:
    """Merges a batch into a table that only merges have written; see ``merge_upsert``.

    ``stamp`` (default: now) is written to ``ingestion_timestamp`` of the batch's rows,
    where the table has that column. ``checked=True`` is for batches known to hold one row
    per complete key.
    """
    spark = batch.sparkSession
    if "startDate" not in keys:
        raise ValueError("a stored table is updated by a key that contains startDate")
    if "ingestion_timestamp" in spark.table(name).columns:
        batch = batch.withColumn("ingestion_timestamp", F.localtimestamp() if stamp is None else stamp)
    if not checked:
        require_unique_keys(batch, keys)
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        merge_plan(batch, name, keys).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(_MODE, before)
    spark.catalog.refreshTable(name)

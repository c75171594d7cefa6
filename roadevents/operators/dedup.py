"""Keeping one row per key.

Each variant is ``row_number() = 1``: Spark then ranks inside every map task and
ships one row per key and task, so a key that holds a large part of the input does
not travel or land whole in one reducer. Null keys form a group of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadevents.functions.text import joined_key
from roadevents.schema import LATEST_KEYS, MERGE_KEYS

_RANK = "_rank_in_key"


def _top_row(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def dedup_first(
    df: DataFrame, keys: Sequence[str] = MERGE_KEYS, order: Sequence[str] = ("seq",)
) -> DataFrame:
    """First row per key in the source order carried by the ``order`` columns."""
    return _top_row(df, keys, [*[F.asc_nulls_last(c) for c in order], _row_hash(df)])


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = LATEST_KEYS,
    recency: str = "createdAt",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Row with the highest ``recency`` per key, a null recency counting as highest.

    Ties go to the highest ``tiebreak`` columns, then to a hash of the row, so that
    a rerun keeps the same row.
    """
    order = [F.desc_nulls_first(c) for c in (recency, *tiebreak)]
    return _top_row(df, keys, [*order, _row_hash(df)])


def snapshot_latest(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = LATEST_KEYS,
    recency: str = "createdAt",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The table after adding a batch: bag union, then the latest row per key."""
    return dedup_latest(existing.unionByName(batch), keys, recency, tiebreak)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Duplicates removed over all columns."""
    return df.distinct()


def with_unique_id(df: DataFrame, keys: Sequence[str] = MERGE_KEYS) -> DataFrame:
    """Adds ``unique_id``, the key columns joined by an underscore."""
    return df.withColumn("unique_id", joined_key(*[F.col(k) for k in keys]))

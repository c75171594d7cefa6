"""Merge of a batch into a table, as a composition of joins.

Meaning: a target row whose key occurs in the batch takes all the batch row's
values; a batch row whose key is not in the target is added. A key with a null part
matches nothing, so such rows are kept on both sides. A target key held by several
rows updates all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.schema import MERGE_KEYS

_HIT = "_hit"
_SPREAD = "_spread"


def require_unique_keys(batch: DataFrame, keys: Sequence[str] = MERGE_KEYS) -> None:
    """Fails if two batch rows share a complete key: which one wins would be open."""
    repeated = batch.dropna(subset=list(keys)).groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"batch holds several rows for one key {tuple(keys)}")


def _incomplete(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def without_replayed(
    target: DataFrame, batch: DataFrame, keys: Sequence[str] = MERGE_KEYS
) -> DataFrame:
    """The batch less its rows without a complete key that the target holds exactly."""
    incomplete = _incomplete(keys)
    held = target.where(incomplete).distinct().alias("held")
    loose = batch.where(incomplete).alias("loose")
    same_row = reduce(
        and_,
        [F.col(f"loose.{c}").eqNullSafe(F.col(f"held.{c}")) for c in target.columns],
    )
    fresh = loose.join(held, same_row, "left_anti")
    return batch.where(~incomplete).unionByName(fresh)


def without_late(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str],
) -> DataFrame:
    """The batch less its rows whose key the target holds in a more recent form.

    ``recency`` are columns of both, compared in their order. Rows without a complete
    key match nothing and stay.
    """
    incomplete = _incomplete(keys)
    held = target.select(
        *[F.col(k).alias(f"_held_{k}") for k in keys], F.struct(*recency).alias("_held")
    )
    same_key = reduce(and_, [F.col(k) == F.col(f"_held_{k}") for k in keys])
    late = same_key & (F.col("_held") > F.struct(*recency))
    fresh = batch.where(~incomplete).join(held, late, "left_anti")
    return fresh.unionByName(batch.where(incomplete))


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = MERGE_KEYS,
    *,
    stamp: Column | None = None,
    stamp_column: str = "ingestion_timestamp",
    unique_target: bool = False,
) -> DataFrame:
    """The target after the merge. The batch must hold one row per complete key.

    ``stamp`` fills ``stamp_column`` of every updated or added row; without it the
    batch brings its own. ``unique_target=True`` promises that no complete key occurs
    twice in the target; the target is then read once instead of twice.

    No side is broadcast by hint: adaptive execution does so when it has measured the
    batch as small, and otherwise sorts both sides and splits a skewed target key.
    """
    columns = target.columns
    if stamp is not None:
        batch = batch.withColumn(stamp_column, stamp)
    batch = batch.select(*columns)

    # Rows without a complete key never match. A running number instead of the key's
    # hash spreads them over all tasks instead of sending them to one.
    incomplete = _incomplete(keys)
    key_hash = F.xxhash64(*keys)
    spread = F.when(incomplete, F.monotonically_increasing_id()).otherwise(key_hash)
    probe = target.withColumn(_SPREAD, spread)
    lookup = batch.where(~incomplete).select(
        *[F.col(c).alias(f"_new_{c}") for c in columns],
        key_hash.alias(f"_new_{_SPREAD}"),
        F.lit(True).alias(_HIT),
    )
    same_key = reduce(
        and_, [F.col(k) == F.col(f"_new_{k}") for k in (*keys, _SPREAD)]
    )

    if unique_target:
        untouched = probe.join(lookup, same_key, "left_anti").select(*columns)
        return untouched.unionByName(batch)

    joined = probe.join(lookup, same_key, "left")
    refreshed = joined.select(
        *[
            F.col(c)
            if c in keys
            else F.when(F.col(_HIT), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            for c in columns
        ]
    )
    # Keys that matched are at most as many as the batch has, so the second join
    # never moves the target either when the batch is small.
    complete = probe.where(~incomplete).select(*keys, _SPREAD)
    matched = complete.join(lookup, same_key, "left_semi").select(*keys).distinct()
    added = batch.join(matched, list(keys), "left_anti").select(*columns)
    return refreshed.unionByName(added)

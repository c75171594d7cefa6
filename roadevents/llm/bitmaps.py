"""Bitmaps of bounded size that tell tasks which keys are worth sending."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import Scratch, mix64

# A map has 2 ** BITS bits, and one sized by its keys more where they are many: about
# KEY_BITS a key, but never more than 2 ** MOST_BITS. Each key of such a map has PROBES slots.
BITS = 26
MOST_BITS = 30
KEY_BITS = 16
PROBES = 3


def slots(keys: np.ndarray, bits: int, probe: int = 0) -> np.ndarray:
    own = keys.view(np.uint64) + np.uint64(probe * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix64(own) >> np.uint64(64 - bits)).astype(np.int64)


class BitMap:
    """The slots of all keys in a table: by default its one bigint column, without nulls,
    else the numbers that ``of`` makes of each batch, so one worker does both.

    It has every key of the table, and others by chance: it only spares work, and whoever
    uses it must be right with more keys than it had.
    """

    def __init__(self, keys: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray] | None = None):
        self.bits, self.probes = BITS, 1
        parts = self._slots(keys, of).groupBy("bucket").agg(_bitmap())
        self._fill(parts)

    @classmethod
    def sized(cls, keys: DataFrame, n: int, scratch: Scratch) -> BitMap:
        """A map of the one column of ``keys``, ``n`` of them or about as many: with so many
        bits that few other keys are in it, also where ``n`` is large."""
        self = cls.__new__(cls)
        self.bits = min(MOST_BITS, max(BITS, (KEY_BITS * n).bit_length()))
        self.probes = PROBES
        # Dealt out before they are gathered: else each task would send a part of every bucket.
        dealt = self._slots(keys).repartition("bucket")
        self._fill(scratch.write(dealt.groupBy("bucket").agg(_bitmap()), "bits"))
        scratch.drop("bits")
        return self

    def _slots(self, keys: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray] | None = None) -> DataFrame:
        bits, probes = self.bits, self.probes

        def numbered(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                own = of(batch) if of else batch.column(0).to_numpy()
                # Spark's bitmaps number the values from 1 on.
                slot = np.concatenate([slots(own, bits, i) for i in range(probes)]) + 1
                yield pa.record_batch([pa.array(slot)], names=["slot"])

        found = keys.mapInArrow(numbered, "slot bigint")
        return found.withColumn("bucket", F.bitmap_bucket_number("slot"))

    def _fill(self, parts: DataFrame) -> None:
        self.held = np.zeros(1 << (self.bits - 3), np.uint8)
        for row in parts.toLocalIterator():
            own = np.frombuffer(row["bits"], np.uint8)
            at = (row["bucket"] - 1) * len(own)
            # A map of fewer bits than a bucket has uses its beginning.
            self.held[at : at + len(own)] = own[: len(self.held) - at]

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for i in range(self.probes):
            own = slots(keys, self.bits, i)
            found &= (self.held[own >> 3] >> (own & 7).astype(np.uint8)) & 1 == 1
        return found


def _bitmap() -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")

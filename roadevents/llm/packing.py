"""Best-fit packing of documents into sequences, with certified counts.

Pieces are dealt to groups and each group is packed by best-fit decreasing. Dual
feasible functions give a number of sequences that no packing of the group can go below.
A group keeps its sequences but for its loosest ones: as many as it has above its bound,
one more, since a group's last sequence is seldom full, and a twentieth of all. Their
pieces are exchanged: pooled with the other groups', dealt again and packed again, until
one group is left.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import steps, written
from roadevents.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
# Pieces that a task packs together, on average.
GROUP = 4000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(
    docs: DataFrame,
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's ids and the end id, cut after each ``capacity`` ids.

    Null text is empty: one piece of the end id alone. ``with_ids`` adds the ids. The
    checksum is over the ids as little-endian 32-bit numbers.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            found = encoder(tokenizer).ids(batch.column("text").to_pylist())
            out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                own = np.append(own, np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(own), capacity):
                    part = own[start : start + capacity]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(start // capacity)
                    out["start"].append(start)
                    out["length"].append(len(part))
                    out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        out["ids"].append(part.astype(np.int32))
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int32())]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=False)]
            yield pa.record_batch(arrays, names=list(out))

    return rows.mapInArrow(run, schema)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """A number of sequences that no packing of ``lengths`` can go below.

    The largest total over two families of dual feasible functions. The first counts a
    length above ``capacity - a`` as full, one below ``a`` as nothing. The second rounds
    a length's share to multiples of 1/k, down unless (k+1) times it is whole.
    """
    counts = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    sizes = np.arange(capacity + 1)
    number, weight = np.cumsum(counts), np.cumsum(counts * sizes)
    best = -(-int(weight[-1]) // capacity)
    a = np.arange(1, capacity // 2 + 1)
    full = number[-1] - number[capacity - a]
    middle = weight[capacity - a] - weight[a - 1]
    best = max(best, int(np.max(full - (-middle // capacity), initial=0)))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        # In units of 1 / (k * capacity), so that all is in whole numbers.
        units = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int(counts @ units) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, longest first, each into the tightest gap."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    # Bit g is set while a sequence has a gap of g.
    gaps, made = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        above = gaps >> length
        if above:
            gap = length + (above & -above).bit_length() - 1
            place = open_bins[gap].pop()
            if not open_bins[gap]:
                gaps &= ~(1 << gap)
        else:
            gap, place, made = capacity, made, made + 1
        bins[i], offsets[i] = place, capacity - gap
        if gap > length:
            open_bins[gap - length].append(place)
            gaps |= 1 << (gap - length)
    return bins, offsets


def _packed(rows: pd.DataFrame, capacity: int, exchange: bool) -> pd.DataFrame:
    rows = rows.sort_values("item").reset_index(drop=True)
    lengths = rows["length"].to_numpy()
    bins, offsets = best_fit(lengths, capacity)
    used = np.bincount(bins, weights=lengths)
    if exchange:
        gap = len(used) - lower_bound(lengths, capacity)
        loose = gap + 1 + len(used) // 20
        free = np.argsort(used, kind="stable")[:loose]
        bins[np.isin(bins, free[used[free] < capacity])] = -1
    return pd.DataFrame(
        {
            "item": rows["item"],
            "length": lengths,
            "grp": rows["grp"],
            "bin": bins,
            "offset": offsets,
        }
    )


def pack(
    items: DataFrame, capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    """item, sequence_id and offset of every row of ``items`` (item, length).

    Items are numbered uniquely and 1 to ``capacity`` long. Each round's result is
    written to the shared folder. Rounds end when one group holds the pool, or when the
    pool has not halved: then the bound is too low to tell, and the groups keep all.
    """
    pool, number = items.select("item", F.col("length").cast("long")), 0
    left, done = pool.count(), []
    schema = "item bigint, length bigint, grp bigint, bin bigint, offset bigint"
    last_left = math.inf
    while True:
        groups = max(1, math.ceil(left / group))
        exchange = groups > 1 and left <= last_left / 2
        dealt = pool.withColumn("grp", F.pmod(F.xxhash64("item", F.lit(number)), F.lit(groups)))
        fit = partial(_packed, capacity=capacity, exchange=exchange)
        packed = dealt.groupBy("grp").applyInPandas(fit, schema)
        packed = written(packed, f"packing-{number}")
        key = F.lit(number << 56) + F.shiftleft("grp", 24) + F.col("bin")
        done.append(packed.where("bin >= 0").select("item", key.alias("sequence_id"), "offset"))
        pool = packed.where("bin < 0").select("item", "length")
        if not exchange:
            break
        last_left, left, number = left, pool.count(), number + 1
        if not left:
            break
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def pack_documents(
    docs: DataFrame,
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    group: int = GROUP,
) -> DataFrame:
    """All documents in as few sequences as the packing finds.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.
    Only documents longer than a sequence are cut. Null text is empty and holds the end
    id alone; repeated rows and null ids are packed like others; other columns are left
    out. Without documents there are no rows.
    """
    # A piece's number stays fixed once it is written, so it can be dealt and joined.
    cut = pieces(docs, text, capacity, tokenizer)
    cut = written(cut.withColumn("item", F.monotonically_increasing_id()), "pieces")
    packed = pack(cut, capacity, group)
    names = [c.split()[0] for c in PIECES.split(", ")]
    return cut.join(packed, "item").select(*names, "sequence_id", "offset")

"""Token sequences in training order, in binary shards of equal records.

A keyed Feistel network permutes the sequence numbers: four rounds over the smallest
even number of bits that holds them all, walked on until the value is a number again.
The result is the sequence's slot. Shard ``s`` holds slots ``s * records`` and on, each
as ``stride`` ids of fixed width, so slot and place in a file follow from each other and
a reader resumes anywhere by arithmetic.

Sequences are cut from the documents' ids one after another, with an end id after each
document, so only the last sequence of a task is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import Scratch, mix64, shared_path, steps
from roadevents.llm.tokens import encoder
from roadevents.session import qualified

STRIDE = 512
RECORDS = 2048
# Shards are written in so many passes; what a pass shuffles is gone before the next.
WAVES = 2
END_ID = 49407
PAD = 49406
KEY = 20_240_607
WIDTH = "<u2"

MANIFEST = (
    "slot bigint, shard bigint, byte_offset bigint, sequence bigint, doc_id bigint, "
    "start bigint, n_tokens int, record_crc32 bigint"
)


def permuted(numbers: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """The slots of ``numbers`` below ``total``: a permutation of them, fixed by ``key``."""
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix64(np.uint64(key) + np.arange(1, 5, dtype=np.uint64))
    slots = np.asarray(numbers, np.uint64).copy()
    walking = np.arange(len(slots))
    while len(walking):
        left, right = slots[walking] >> half, slots[walking] & mask
        for round_key in keys:
            left, right = right, left ^ (mix64(right ^ round_key) & mask)
        slots[walking] = (left << half) | right
        walking = walking[slots[walking] >= total]
    return slots.astype(np.int64)


def sequences(
    docs: DataFrame, text: str = "text", stride: int = STRIDE, tokenizer: str | None = None
) -> DataFrame:
    """The documents' ids, END_ID after each, cut at ``stride``: doc_id and start tell
    which document a sequence begins in and at which of its ids; n_tokens and tokens
    (little-endian bytes) follow.

    Null and empty texts are an end id alone. A sequence does not go on in another task.
    """
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = stride * np.dtype(WIDTH).itemsize

    def run(batches: Iterator[pa.RecordBatch]):
        held, at = bytearray(), (None, 0)
        for batch in steps(batches):
            out: list[tuple] = []
            found = encoder(tokenizer).ids(batch.column("text").to_pylist())
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                own = narrowed(np.append(own, np.uint32(END_ID)))
                if not held:
                    at = (doc_id, 0)
                before = len(held)
                held += own
                while len(held) >= size:
                    out.append((*at, stride, bytes(held[:size])))
                    del held[:size]
                    # The next one begins in this document, or with the one after it.
                    used = size - before
                    before = -used
                    at = (doc_id, used // np.dtype(WIDTH).itemsize)
            yield _batch(out)
        if held:
            yield _batch([(*at, len(held) // np.dtype(WIDTH).itemsize, bytes(held))])

    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens int, tokens binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, types = ("doc_id", "start", "n_tokens", "tokens"), (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def narrowed(ids: np.ndarray) -> bytes:
    """Ids at the shards' width; one that does not fit is an error."""
    if len(ids) and int(ids.max()) > np.iinfo(WIDTH).max:
        raise ValueError(f"token id {int(ids.max())} does not fit {WIDTH}")
    return ids.astype(WIDTH).tobytes()


@dataclass(frozen=True)
class Shards:
    """Where the shards are and how they are laid out; ``manifest`` has a row per slot."""

    path: str
    total: int
    stride: int
    records: int
    manifest: DataFrame

    def read(self, first: int, count: int) -> np.ndarray:
        """The records of ``count`` slots from ``first`` on, as rows of ids."""
        store, folder = fs.FileSystem.from_uri(self.path)
        size, end, parts = self.stride * np.dtype(WIDTH).itemsize, min(first + count, self.total), []
        while first < end:
            shard, at = divmod(first, self.records)
            n = min(end - first, self.records - at)
            with store.open_input_file(f"{folder}/{shard_name(shard)}") as file:
                parts.append(file.read_at(n * size, at * size))
            first += n
        return np.frombuffer(b"".join(parts), WIDTH).reshape(-1, self.stride)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _write(
    batches: Iterator[pa.RecordBatch], path: str, stride: int, records: int, pad: int
):
    """Writes each shard under a name of this attempt and renames it when it is whole."""
    store, folder = fs.FileSystem.from_uri(path)
    attempt = TaskContext.get().taskAttemptId()
    size = stride * np.dtype(WIDTH).itemsize
    padding = np.full(stride, pad, WIDTH).tobytes()
    shard, file, part = None, None, ""

    def close():
        if file is not None:
            file.close()
            store.move(part, f"{folder}/{shard_name(shard)}")

    for batch in steps(batches, "tokens"):
        slots = batch.column("slot").to_pylist()
        checks, offsets = [], []
        for slot, tokens in zip(slots, batch.column("tokens").to_pylist(), strict=True):
            if slot // records != shard:
                close()
                shard = slot // records
                part = f"{folder}/_{shard_name(shard)}.{attempt}"
                file = store.open_output_stream(part)
            record = tokens + padding[len(tokens) :]
            file.write(record)
            checks.append(zlib.crc32(record))
            offsets.append(slot % records * size)
        columns = {n: batch.column(n) for n in ("slot", "shard", "sequence", "doc_id", "start", "n_tokens")}
        columns |= {"byte_offset": pa.array(offsets, pa.int64()), "record_crc32": pa.array(checks, pa.int64())}
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        yield pa.record_batch([columns[n] for n in names], names=names)
    close()


def materialise(
    rows: DataFrame,
    path: str,
    stride: int = STRIDE,
    records: int = RECORDS,
    key: int = KEY,
    pad: int = PAD,
) -> Shards:
    """Writes the sequences (doc_id, start, n_tokens, tokens) to shards under ``path``.

    Sequences are first written to the shared folder, which fixes their numbers: by
    writing task, then by place in it. The driver learns one count per task. A task that
    is run again writes the same shards again. ``path`` is a URI that pyarrow opens on
    every executor. Equal rows each have a slot; without rows there is no shard.
    """
    stored = rows.select("doc_id", "start", "n_tokens", "tokens")
    scratch = Scratch(rows.sparkSession, "sequences")
    stored = stored.withColumn("at", F.monotonically_increasing_id())
    stored = scratch.write(stored, "stored", "zstd")
    task, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = stored.groupBy(task.alias("task")).count().orderBy("task").collect()
    tasks = np.array([r["task"] for r in counts], np.int64)
    before = np.cumsum([0, *[r["count"] for r in counts]])
    total = int(before[-1])

    def slots(batches: Iterator[pa.RecordBatch], wave: int):
        for batch in batches:
            own = np.searchsorted(tasks, batch.column("task").to_numpy())
            number = before[own] + batch.column("place").to_numpy()
            slot = permuted(number, total, key)
            # Rows of other passes do not leave the worker.
            mine = slot // records % WAVES == wave
            batch, number, slot = batch.filter(pa.array(mine)), number[mine], slot[mine]
            columns = [batch.column(n) for n in ("doc_id", "start", "n_tokens", "tokens")]
            columns += [pa.array(x, pa.int64()) for x in (number, slot, slot // records)]
            yield pa.record_batch(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "tokens", "sequence", "slot", "shard"]
    placed = stored.select("doc_id", "start", "n_tokens", "tokens", task.alias("task"), place.alias("place"))
    ddl = (
        "doc_id bigint, start bigint, n_tokens int, tokens binary, "
        "sequence bigint, slot bigint, shard bigint"
    )
    store, folder = fs.FileSystem.from_uri(path)
    store.create_dir(folder)
    shards, parts = max(1, -(-total // records)), []
    for wave in range(WAVES):
        own = placed.mapInArrow(lambda b, wave=wave: slots(b, wave), ddl)
        # A task writes one shard.
        place = F.expr(f"CAST(shard div {WAVES} AS int)")
        ordered = own.repartitionById(-(-shards // WAVES), place).sortWithinPartitions("slot")
        done = ordered.mapInArrow(lambda b: _write(b, path, stride, records, pad), MANIFEST)
        parts.append(scratch.write(done, f"manifest-{wave}"))
    scratch.drop("stored")
    return Shards(path, total, stride, records, reduce(DataFrame.unionByName, parts))


def materialise_documents(docs: DataFrame, path: str | None = None, **options) -> Shards:
    """``materialise`` for the token ids of all documents' texts.

    Columns of other names are left out; null ids and repeated rows have their slots. A
    text of any length is tokenised whole, one at least at a time. An empty table has no
    shards.
    """
    if path is None:
        path = shared_path(docs.sparkSession, "shards")
        path = qualified(docs.sparkSession, path)
    stride = options.get("stride", STRIDE)
    return materialise(sequences(docs, stride=stride), path, **options)

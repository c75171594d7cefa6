"""Document fingerprints from content-defined chunks.

A text's UTF-8 bytes are cut where a gear hash of the last 32 bytes has certain bits
zero. Below the normal chunk size more bits must be zero than above it, which keeps
sizes near the normal one. Cuts depend on nearby bytes only, so an insertion changes
the chunks around it and leaves the rest. A fingerprint is the set of the chunks'
digests with their lengths; how much of one lies in another is measured in bytes.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import steps

SMALLEST, NORMAL, LARGEST = 24, 64, 192
HARD, EASY = np.uint32(0xFE000000), np.uint32(0xF8000000)
GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, np.uint32)

Chunks = dict[bytes, int]

COLUMNS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def gear(data: bytes) -> np.ndarray:
    """At each byte the sum of the last 32 bytes' gear values, each shifted by its age."""
    found = GEAR[np.frombuffer(data, np.uint8)]
    for width in (1, 2, 4, 8, 16):
        older = found[:-width] << np.uint32(width)
        found[width:] += older
    return found


def cuts(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end."""
    found = gear(data)
    easy = (np.flatnonzero((found & EASY) == 0) + 1).tolist()
    hard = (np.flatnonzero((found & HARD) == 0) + 1).tolist()
    ends, at, size = [], 0, len(data)
    while size - at > SMALLEST:
        normal, last = at + NORMAL, min(at + LARGEST, size)
        i = bisect_left(hard, at + SMALLEST)
        if i < len(hard) and hard[i] < normal:
            at = hard[i]
        else:
            i = bisect_left(easy, normal)
            at = easy[i] if i < len(easy) and easy[i] < last else last
        ends.append(at)
    if at < size:
        ends.append(size)
    return ends


def chunks(text: str) -> Chunks:
    """Length by digest of the text's distinct chunks."""
    data, at, found = text.encode(), 0, {}
    digest = xxhash.xxh3_64_digest
    for end in cuts(data):
        found[digest(data[at:end])] = end - at
        at = end
    return found


def encoded(found: Chunks) -> str:
    """The set as text: digest and length of each chunk in the digests' order."""
    parts = [d + n.to_bytes(2, "big") for d, n in sorted(found.items())]
    return base64.b64encode(b"".join(parts)).decode()


def decoded(fingerprint: str) -> Chunks:
    raw = base64.b64decode(fingerprint)
    return {
        raw[i : i + 8]: int.from_bytes(raw[i + 8 : i + 10], "big")
        for i in range(0, len(raw), 10)
    }


def containment(one: Chunks, other: Chunks) -> float:
    """The part of ``one`` that ``other`` has, by length; nothing is only in nothing."""
    if not one:
        return float(not other)
    small, large = sorted((one, other), key=len)
    return sum(one[d] for d in small if d in large) / sum(one.values())


def fingerprints(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` and the fingerprint of every row; null text counts as empty."""
    if {"fingerprint", "__text"} & set(keep):
        raise ValueError("kept columns clash with the result's")
    schema = docs.select(*keep, F.lit("").alias("fingerprint")).schema
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches, "__text"):
            found = [encoded(chunks(t)) for t in batch.column("__text").to_pylist()]
            columns = [*batch.columns[:-1], pa.array(found, pa.string())]
            yield pa.record_batch(columns, names=[*keep, "fingerprint"])

    return rows.mapInArrow(run, schema)


def _ranges(ids: DataFrame, parts: int) -> dict[int, int]:
    """Up to ``parts - 1`` dividing lines with about as many rows between them, and how many
    lines fell on each id: several on an id that has many rows."""
    shares = [i / parts for i in range(1, parts)]
    lines = ids.approxQuantile("id", shares, 0.2 / parts) if shares else []
    return dict(Counter(sorted(int(x) for x in lines)))


def _part(lines: dict[int, int]) -> Column:
    """The range of a row, from the highest ids down.

    An id with lines is spread over the ranges on both sides of each, by equal stretches of
    its texts' hashes.
    """
    if not lines:
        return F.lit(0)
    pairs = F.lit([[x, n] for x, n in lines.items()]).cast("array<array<bigint>>")
    above = F.filter(pairs, lambda p: p[0] > F.col("id"))
    base = F.aggregate(above, F.lit(0).cast("long"), lambda n, p: n + p[1])
    own = F.get(F.get(F.filter(pairs, lambda p: p[0] == F.col("id")), 0), 1)
    # The hash's rank among all, as a share of one: its highest 31 bits.
    share = (F.shiftright("hash", 33) + F.lit(1 << 30)) * (own + 1)
    return (base + F.coalesce(F.shiftright(share, 31), F.lit(0))).cast("int")


def with_next(docs: DataFrame, text: str = "text", parts: int | None = None) -> DataFrame:
    """Every row's text, packed, sorted so that the next document follows.

    Documents are dealt to ``parts`` ranges of doc_id in descending order, and of the text's
    hash where one id has many rows; a range is one task, and also gets a copy (``extra``)
    of the first document after it. The driver learns some numbers per range. Each text is
    shuffled once, compressed.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-(2**63))).alias("id"),
        F.xxhash64(value).alias("hash"),
        value.alias("text"),
    )
    rows = rows.withColumn("part", _part(_ranges(rows.select("id"), parts)))
    # Turned around, the highest id is the least.
    place = F.struct(F.bitwise_not("id").alias("turned"), "hash")
    firsts = rows.groupBy("part").agg(F.min(place).alias("first")).orderBy("part").collect()
    target = F.lit(None).cast("int")
    if firsts:
        names = F.lit([f"{r['first']['turned']},{r['first']['hash']}" for r in firsts])
        before = F.lit([firsts[i - 1]["part"] for i in range(len(firsts))])
        own = F.concat_ws(",", F.bitwise_not("id"), F.col("hash"))
        target = F.map_from_arrays(names, before)[own]
    copies = F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("extra")),
        F.struct(target.alias("part"), F.lit(True).alias("extra")),
    )
    copies = F.filter(copies, lambda c: c["part"].isNotNull())
    columns = ("doc_id", "id", "hash", "text")
    dealt = rows.select(*columns, F.explode(copies).alias("to"))
    dealt = dealt.select("doc_id", "id", "hash", "to.part", "to.extra", "text")

    def pack(batches: Iterator[pa.RecordBatch]):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in steps(batches):
            packed = [squeeze(t.encode()) for t in batch.column("text").to_pylist()]
            columns = [*batch.columns[:-1], pa.array(packed, pa.binary())]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], "packed"])

    packed = dealt.mapInArrow(
        pack, "doc_id bigint, id bigint, hash bigint, part int, extra boolean, packed binary"
    )
    return packed.repartitionById(parts, "part").sortWithinPartitions(
        "part", "extra", F.desc("id"), "hash", "packed"
    )


def _edited(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    unpack = zstandard.ZstdDecompressor().decompress
    pending, part, out, held = None, None, [], 0

    def finish(now, then):
        doc_id, text, own = now
        _, next_text, other = then
        count = len(text) // 3
        changed = text[: len(text) - count] + next_text[:count]
        new = chunks(changed)
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": encoded(own),
            "edited_fingerprint": encoded(new),
            "near_edited": containment(own, new),
            "near_next": containment(own, other),
        }

    for batch in steps(batches, "packed"):
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "part", "extra", "packed"))
        for doc_id, new_part, extra, packed in zip(*columns, strict=True):
            if extra and pending is None:
                continue
            text = unpack(packed).decode()
            now = (doc_id, text, chunks(text))
            if pending is not None and new_part == part:
                out.append(finish(pending, now))
                held += len(text)
            pending, part = (None if extra else now), new_part
            if held > 1 << 22:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
    yield pa.RecordBatch.from_pylist(out, schema)


def near_after_edit(docs: DataFrame, text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike they are.

    The edit replaces the last third of the characters, rounded down, by the first as
    many of the next document (all, if it has fewer). Next is by descending doc_id, and
    the first follows the last; a single document follows itself. Rows of one doc_id
    follow each other in the order of their texts' hashes; a null doc_id comes last. Null
    text is empty and contained in empty text only. A text of any length is read whole, two
    at least at a time. An empty table gives no rows. ``near_next`` is the part of the
    document's fingerprint that the next document's has. Columns of other names are
    left out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(COLUMNS))
    return with_next(docs, text, parts).mapInArrow(lambda b: _edited(b, arrow), COLUMNS)

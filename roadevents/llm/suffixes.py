"""Removal of long repeated byte strings by anchors and digests.

This replaces bucket-pointer refinement: no bucket is refined by the identifiers of later
offsets, and no refined identifier is used again.

A string of ``LENGTH`` bytes is repeated when it also starts earlier. Suffixes are not
all kept: a string's anchor is the smallest q-gram in it by identifier, the leftmost of
equals, and only anchors are. Equal strings have equal anchors at equal offsets, so the
first buckets are the anchors' q-grams, and a bucket of one holds no repetition.

Buckets are then split. A member of a bucket stands for a run of strings; it gets a
128-bit digest of all bytes of the run. Doubling (the identifier of 2k bytes joins those of
k bytes here and k bytes later) makes only the identifiers of q-grams, inside a text. Among members of one identifier all but the earliest are
repeated. The earliest of several identifiers in one bucket are split into shorter runs,
whose buckets are the bytes that all strings of the run share, and split again: first
the strings of one anchor, then eight strings, then single ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadevents.llm.bitmaps import BitMap
from roadevents.llm.common import Scratch, mix64, no_worker_cache, steps

LENGTH = 100
Q = 32
BLOCK = 8
# Window starts that one step looks at; place numbers take PLACE_BITS of an identifier.
STARTS = 1 << 20
PLACE_BITS = 24
# Bytes of short texts that one step looks at together; members that a task compares, and
# those of them that go to Spark at once.
GROUP = 1 << 16
CHUNK = 1 << 17
PART = 20_000
# A run has fewer strings; a run in one number takes these bits for them.
RUN_BITS = 7

BYTES = mix64(np.arange(1, 257, dtype=np.uint64))
MEMBER = (
    "key bigint, id_1 bigint, id_2 bigint, lot bigint, doc_id bigint, doc_hash bigint, "
    "start bigint, n bigint"
)


def identifiers(data: np.ndarray, length: int) -> np.ndarray:
    """An identifier of the ``length`` (a power of two) bytes from each place on."""
    found, k = BYTES[data], 1
    while k < length:
        later = found[k:]
        found = found[:-k] * np.uint64(0x9E3779B97F4A7C15)
        found += later
        found ^= found >> np.uint64(29)
        k *= 2
    return found * np.uint64(0xBF58476D1CE4E5B9)


def anchors(
    data: np.ndarray, length: int = LENGTH, q: int = Q, ends: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Identifier and place of each anchor, and the first and last of its strings.

    ``ends`` are those of the texts that ``data`` holds one behind the other (default: it
    is one text). Strings lie within a text.
    """
    keys, places, first, last = [], [], [], []
    ends = np.array([len(data)]) if ends is None else ends
    # A text's first string, and the place after its last.
    bounds = np.concatenate(([0], ends[:-1], ends - length + 1))
    for at in range(0, len(data) - length + 1, STARTS):
        part = data[at : at + STARTS + length - 1]
        ids = identifiers(part, q)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        least, k, span = (ids & ~mask) | np.arange(len(ids), dtype=np.uint64), 1, length - q + 1
        while 2 * k <= span:
            least = np.minimum(least[:-k], least[k:])
            k *= 2
        if k < span:
            least = np.minimum(least[: k - span], least[span - k :])
        place = (least & mask).astype(np.int64)
        turns = np.flatnonzero(np.diff(place)) + 1
        cuts = bounds[(bounds > at) & (bounds < at + len(place))] - at
        begin = np.unique(np.concatenate(([0], turns, cuts)))
        end = np.append(begin[1:], len(place)) - 1
        whole = begin + at + length <= ends[np.searchsorted(ends, begin + at, side="right")]
        begin, end = begin[whole], end[whole]
        keys.append(ids[place[begin]])
        places.append(place[begin] + at)
        first.append(begin + at)
        last.append(end + at)
    if not keys:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in (keys, places, first, last))


# As a place: the document as a whole.
WHOLE = np.array([-1], np.int64)


def _spots(doc_id: np.ndarray, doc_hash: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A number for each place of a document, or of documents."""
    seeds = [mix64(np.atleast_1d(x).astype(np.int64).view(np.uint64)) for x in (doc_id, doc_hash)]
    return mix64(seeds[0] ^ (seeds[1] * np.uint64(3)) ^ places.view(np.uint64)).view(np.int64)


class _Texts(NamedTuple):
    """Texts one behind the other, and their anchors by place in ``data``."""

    doc_id: np.ndarray
    doc_hash: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    data: bytes
    keys: np.ndarray
    places: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray  # the number of each anchor's text


def _held_bytes(column: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of a column without nulls, and the bounds of its values in them."""
    column = column.cast(pa.large_binary())
    _, bounds, data = column.buffers()
    return data, np.frombuffer(bounds, np.int64, len(column) + 1, column.offset * 8)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[_Texts]:
    """Short texts in groups, others alone. What is found in a text does not depend on the
    group it is in."""
    no_worker_cache()
    most = min(GROUP, STARTS)
    for batch in steps(batches):
        if not batch.num_rows:
            continue
        ids = [batch.column(c).to_numpy() for c in DOC]
        held, bounds = _held_bytes(batch.column("text"))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, side="right")) - 1)
            low, high = int(bounds[i]), int(bounds[j])
            if high - low >= LENGTH:
                data, ends = held[low:high].to_pybytes(), bounds[i + 1 : j + 1] - low
                found = anchors(np.frombuffer(data, np.uint8), ends=ends)
                text = np.searchsorted(ends, found[2], side="right")
                begins = bounds[i:j] - low
                yield _Texts(ids[0][i:j], ids[1][i:j], begins, ends, data, *found, text)
            i = j


def _keys(batches: Iterator[pa.RecordBatch]):
    held: list[np.ndarray] = []
    for texts in _texts(batches):
        held.append(texts.keys)
        if len(held) >= 32:
            yield pa.record_batch([pa.array(np.concatenate(held).view(np.int64))], names=["key"])
            held = []
    if held:
        yield pa.record_batch([pa.array(np.concatenate(held).view(np.int64))], names=["key"])


def _lots(ids: list[np.ndarray], at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of members with identifiers ``ids`` at ``at``: which to keep, and their lots.

    The earliest of an identifier has lot 0, and all others a number that spreads them;
    they are repeated. Of members at one place, in equal rows, one is kept.
    """
    keep, lots = np.ones(len(ids[0]), bool), np.zeros(len(ids[0]), np.int64)
    order = np.argsort(ids[0])
    equal = np.diff(ids[0][order]) == 0
    shared = np.zeros(len(order), bool)
    shared[1:] |= equal
    shared[:-1] |= equal
    some = order[shared]
    some = some[np.lexsort([*(x[some] for x in reversed(at)), ids[1][some], ids[0][some]])]
    columns = [x[some] for x in (*ids, *at)]
    turns = [np.append(True, np.diff(c) != 0)[: len(some)] for c in columns]
    keep[some] = np.logical_or.reduce(turns)
    later = some[~(turns[0] | turns[1])]
    lots[later] = _spots(*(x[later] for x in at)) | 1
    return keep, lots


class _Chunks:
    """Members gathered by column, compared among themselves and given out in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.held, self.rows = schema, [], 0

    def add(self, key, digests: list[bytes], *columns: np.ndarray) -> None:
        """``columns``: doc_id, doc_hash, start, n and the further ones of the schema."""
        if digests:
            ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            self.held.append((key, ids[:, 0], ids[:, 1], *columns))
            self.rows += len(digests)

    def batches(self, least: int = CHUNK) -> Iterator[pa.RecordBatch]:
        """A batch, if there are ``least`` members."""
        if self.held and self.rows >= least:
            key, *rest = (np.concatenate(c) for c in zip(*self.held, strict=True))
            self.held, self.rows = [], 0
            keep, lots = _lots(rest[:2], rest[2:5])
            columns = (key, *rest[:2], lots, *rest[2:])
            arrays = [pa.array(c[keep]) for c in columns]
            whole = pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            for at in range(0, whole.num_rows, PART):
                yield whole.slice(at, PART)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _members(batches: Iterator[pa.RecordBatch], repeated: BitMap, schema: pa.Schema):
    """The anchors in buckets of several, each with the run of its strings."""
    digest, found = xxhash.xxh3_128_digest, _Chunks(schema)
    for texts in _texts(batches):
        kept = np.flatnonzero(repeated.has(texts.keys))
        place, a, z, own = (x[kept] for x in (texts.places, texts.first, texts.last, texts.text))
        runs = zip(a.tolist(), (z + LENGTH).tolist(), (place - a).tolist(), strict=True)
        data, begin = texts.data, texts.begins[own]
        digests = [digest(data[i:j], seed=k) for i, j, k in runs]
        at = texts.doc_id[own], texts.doc_hash[own], a - begin
        found.add(texts.keys[kept].view(np.int64), digests, *at, z - a + 1, place - begin)
        yield from found.batches()
    yield from found.batches(1)


CONTEXT = (
    "rep bigint, key bigint, doc_id bigint, doc_hash bigint, place bigint, first bigint, "
    "last bigint, base bigint, context binary"
)
CONTEXT_NUMBERS = ["rep", "key", "doc_id", "doc_hash", "place", "first", "last", "base"]


def _contexts(batches: Iterator[pa.RecordBatch], wanted: BitMap, schema: pa.Schema):
    """The bytes around the anchors whose runs must be split."""

    def some() -> Iterator[pa.RecordBatch]:
        # Most documents have none, and are left aside before they are read.
        for batch in batches:
            ids = [batch.column(c).to_numpy() for c in DOC]
            yield batch.filter(pa.array(wanted.has(_spots(*ids, WHOLE))))

    for t in _texts(some()):
        begin = t.begins[t.text]
        spots = _spots(t.doc_id[t.text], t.doc_hash[t.text], t.places - begin)
        kept = np.flatnonzero(wanted.has(spots))
        if not len(kept):
            continue
        own, begin, place = t.text[kept], begin[kept], t.places[kept]
        base = np.maximum(begin, place - LENGTH)
        end = np.minimum(t.ends[own], place + LENGTH + BLOCK)
        around = [t.data[i:j] for i, j in zip(base.tolist(), end.tolist(), strict=True)]
        columns = (t.keys[kept].view(np.int64), t.doc_id[own], t.doc_hash[own], place - begin)
        columns += (t.first[kept] - begin, t.last[kept] - begin, base - begin)
        arrays = [*map(pa.array, columns), pa.array(around, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _each(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``count`` things of each row: their rows, and their numbers within them."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def _split(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """Runs of up to BLOCK strings around each anchor, and the bytes they share as key."""
    digest, number = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
    found = _Chunks(schema)
    for batch in batches:
        if not batch.num_rows:
            continue
        c = {f: batch.column(f).to_numpy() for f in CONTEXT_NUMBERS}
        held, bounds = _held_bytes(batch.column("context"))
        low = int(bounds[0])
        text = held[low : int(bounds[-1])].to_pybytes()
        # Blocks of strings by their distance before the anchor that meet the run.
        least, most = ((c["place"] - c[x]) // BLOCK for x in ("last", "first"))
        row, block = _each(most - least + 1)
        block = block + least[row]
        far = c["place"][row] - block * BLOCK - BLOCK + 1
        near = far + BLOCK - 1
        # A place in the document is one in the text of all contexts.
        base, shift = c["base"][row], (bounds[:-1] - low - c["base"])[row]
        end = base + np.diff(bounds)[row]
        a, z = np.maximum(far, base), np.minimum(near, end - LENGTH)
        kept = np.flatnonzero(a <= z)
        row, block, far, near, base, shift, end, a, z = (
            x[kept] for x in (row, block, far, near, base, shift, end, a, z)
        )
        seeds = c["key"][row].view(np.uint64) + block.astype(np.uint64)
        begin = np.maximum(near, base)
        stop = np.maximum(np.minimum(far + LENGTH, end), begin)
        shared = zip((begin + shift).tolist(), (stop + shift).tolist(), seeds.tolist(), strict=True)
        keys = np.array([number(text[i:j], seed=k) for i, j, k in shared], np.uint64)
        # The same bytes in two buckets are two identifiers, so each bucket has its earliest.
        seeds = keys + (a - far).astype(np.uint64)
        runs = zip((a + shift).tolist(), (z + LENGTH + shift).tolist(), seeds.tolist(), strict=True)
        digests = [digest(text[i:j], seed=k) for i, j, k in runs]
        at = c["doc_id"][row], c["doc_hash"][row], a
        found.add(keys.view(np.int64), digests, *at, z - a + 1, c["rep"][row])
        yield from found.batches()
    yield from found.batches(1)


def _singles(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """Single strings of the blocks that must be split."""
    digest, found = xxhash.xxh3_128_digest, _Chunks(schema)
    for batch in batches:
        if not batch.num_rows:
            continue
        c = {f: batch.column(f).to_numpy() for f in (*DOC, "base", "start", "n")}
        held, bounds = _held_bytes(batch.column("context"))
        low = int(bounds[0])
        text = held[low : int(bounds[-1])].to_pybytes()
        row, at = _each(c["n"])
        at = at + c["start"][row]
        places = (at + (bounds[:-1] - low - c["base"])[row]).tolist()
        digests = [digest(text[i : i + LENGTH]) for i in places]
        one = np.ones(len(row), np.int64)
        found.add(one, digests, c["doc_id"][row], c["doc_hash"][row], at, one)
        yield from found.batches()
    yield from found.batches(1)


DOC = ("doc_id", "doc_hash")


def _resolve(members: DataFrame, scratch: Scratch, level: str, *extra: str):
    """Repeated runs (doc, start, n), and the earliest members of every bucket's
    identifiers where a bucket has several (on the last level, without ``extra``: none).

    Members come with a lot: what a task has seen repeated has one of its own, so an
    identifier meets here with at most one member of each chunk of a task.
    """
    same = Window.partitionBy("id_1", "id_2", "lot").orderBy(*DOC, "start")
    ranked = members.withColumns({"_rank": F.rank().over(same), "_row": F.row_number().over(same)})
    repeated = (F.col("lot") != 0) | (F.col("_rank") > 1)
    if not extra:
        return scratch.write(ranked.where(repeated).select(*DOC, "start", "n"), f"marks-{level}"), None
    # Members of equal rows share a rank: neither is repeated, and one is the earliest.
    told = ranked.withColumn("repeated", repeated).where("repeated or _row = 1")
    told = scratch.write(told.select("key", *DOC, "start", "n", *extra, "repeated"), f"members-{level}")
    marks, firsts = told.where("repeated").select(*DOC, "start", "n"), told.where("not repeated")
    several = firsts.groupBy("key").count().where("count > 1").select("key")
    open_ = firsts.join(several, "key", "left_semi").select("key", *DOC, "start", "n", *extra)
    return marks, scratch.write(open_, f"open-{level}")


def repeated_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Runs of repeated strings: doc_id, doc_hash (of the text), start, n.

    ``n`` strings of LENGTH bytes start at ``start`` and the places after it, and each
    also starts earlier. All such strings are in a run, some in more than one.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    broadcast = docs.sparkSession.sparkContext.broadcast
    rows = keyed(docs, text)
    keys = rows.mapInArrow(_keys, "key bigint").groupBy("key").count()
    # Written, so the exchange of all keys goes.
    keys = scratch.write(keys.where("count > 1").select("key"), "keys")
    repeated = broadcast(BitMap.sized(keys, keys.count(), scratch))
    scratch.drop("keys")

    ddl = f"{MEMBER}, place bigint"
    arrow = _arrow(ddl)
    members = rows.mapInArrow(lambda b: _members(b, repeated.value, arrow), ddl)
    marks, open_ = _resolve(members, scratch, "anchor", "place")

    def spots(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = _spots(*(batch.column(c).to_numpy() for c in (*DOC, "place")))
            yield pa.record_batch([pa.array(found)], names=["spot"])

    whole = open_.select(*DOC).distinct().withColumn("place", F.lit(int(WHOLE[0])).cast("long"))
    places = open_.select(*DOC, "place").unionByName(whole).mapInArrow(spots, "spot bigint")
    wanted = broadcast(BitMap.sized(places, open_.count(), scratch))
    ddl = CONTEXT.removeprefix("rep bigint, ")
    arrow_contexts = _arrow(ddl)
    contexts = rows.mapInArrow(lambda b: _contexts(b, wanted.value, arrow_contexts), ddl)
    contexts = contexts.withColumn("rep", F.monotonically_increasing_id())
    contexts = scratch.write(contexts, "contexts")

    ddl = f"{MEMBER}, rep bigint"
    arrow_split = _arrow(ddl)
    split = contexts.mapInArrow(lambda b: _split(b, arrow_split), ddl)
    more, open_ = _resolve(split, scratch, "block", "rep")
    marks = marks.unionByName(more)

    # A context meets at most as many blocks as LENGTH / BLOCK and a few.
    again = contexts.select("rep", *DOC, "base", "context").join(open_.select("rep", "start", "n"), "rep")
    arrow_single = _arrow(MEMBER)
    singles = again.mapInArrow(lambda b: _singles(b, arrow_single), MEMBER)
    more, _ = _resolve(singles, scratch, "single")
    scratch.drop("contexts", "open-anchor", "open-block")
    return marks.unionByName(more)


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id (a null one lowest), doc_hash and text (null: empty)."""
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"),
        F.xxhash64(value).alias("doc_hash"),
        value.alias("text"),
    )


def removed(sizes: np.ndarray, runs: pa.Array) -> list[list[tuple[int, int]]]:
    """The maximal removed stretches, start and end, of texts of ``sizes`` bytes with
    ``runs`` (a list each, or null) as numbers."""
    counts = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
    row, own = np.repeat(np.arange(len(sizes)), counts), pc.list_flatten(runs).to_numpy()
    start, n = own >> RUN_BITS, own & ((1 << RUN_BITS) - 1)
    # Places in all texts, of which no two touch.
    base = np.cumsum(sizes + 1) - sizes - 1
    first, end = start + base[row], np.minimum(start + n - 1 + LENGTH, sizes[row]) + base[row]
    order = np.argsort(first)
    first, reach, row = first[order], np.maximum.accumulate(end[order]), row[order]
    opens = np.flatnonzero(np.append(True, first[1:] > reach[:-1])[: len(first)])
    closes = np.append(opens[1:], len(first))[: len(opens)] - 1
    row = row[opens]
    found = (row, first[opens] - base[row], reach[closes] - base[row])
    spans: list[list[tuple[int, int]]] = [[] for _ in sizes]
    for i, a, z in zip(*(x.tolist() for x in found), strict=True):
        spans[i].append((a, z))
    return spans


def deduplicated(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str, str] = ("kept", "kept_text", "spans"),
) -> DataFrame:
    """Columns ``keep`` of every row, what is kept of its bytes, and what was removed.

    Three columns follow the kept ones: ``kept`` (binary), ``kept_text`` (the same as
    text, without characters that were cut through) and ``spans``, the starts and ends of
    the removed stretches. ``names`` gives them other names.

    Every byte in a string of LENGTH bytes that also starts earlier goes: in a document of
    smaller doc_id, or earlier in the same. Rows of one doc_id rank by a hash of their
    text; equal rows count as one document, so neither removes the other, and each is
    reported. A null doc_id ranks first. Null text is empty. A text of any length is read
    whole, its anchors in parts of it; a task holds one text at least. An empty table gives
    no rows.
    """
    if set(names) & set(keep):
        raise ValueError("kept columns clash with the result's")
    runs = repeated_strings(docs, text)
    run = F.shiftleft("start", RUN_BITS) + F.col("n")
    gathered = runs.groupBy(*DOC).agg(F.collect_list(run).alias("runs"))
    kept = [F.col(f"`{c}`") for c in keep]
    rows = docs.select(
        F.struct(*[c.alias(f"c{i}") for i, c in enumerate(kept)]).alias("kept"),
        F.col(text).alias("text"),
        "doc_id",
    )
    value = F.coalesce("text", F.lit(""))
    rows = rows.select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"),
        F.xxhash64(value).alias("doc_hash"),
        "kept",
        value.alias("text"),
    )

    def pack(batches: Iterator[pa.RecordBatch]):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in steps(batches):
            packed = [squeeze(t.encode()) for t in batch.column("text").to_pylist()]
            columns = [*batch.columns[:-1], pa.array(packed, pa.binary())]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], "packed"])

    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("packed", T.BinaryType())])
    joined = rows.mapInArrow(pack, schema).join(gathered, list(DOC), "left")
    joined = joined.select("kept", "packed", "runs")
    out = T.StructType(
        [
            rows.schema["kept"],
            T.StructField("bytes", T.BinaryType()),
            T.StructField("clean", T.StringType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in steps(batches, "packed"):
            whole = [unpack(packed) for packed in batch.column("packed").to_pylist()]
            texts, spans = [], []
            sizes = np.array([len(data) for data in whole], np.int64)
            for data, found in zip(whole, removed(sizes, batch.column("runs")), strict=True):
                at, parts = 0, []
                for a, z in found:
                    parts.append(data[at:a])
                    at = z
                texts.append(b"".join([*parts, data[at:]]))
                spans.append(found)
            yield pa.record_batch(
                [
                    batch.column("kept"),
                    pa.array(texts, pa.binary()),
                    pa.array([t.decode(errors="ignore") for t in texts], pa.string()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                ],
                names=["kept", "bytes", "clean", "spans"],
            )

    found = joined.mapInArrow(cut, out)
    return found.select(
        *[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(keep)],
        *[F.col(c).alias(n) for c, n in zip(("bytes", "clean", "spans"), names, strict=True)],
    )


def dedup_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, sizes and a digest of what each row of ``docs`` keeps."""
    found = deduplicated(docs, text)
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x[1] - x[0])
    return found.select(
        "doc_id",
        (F.octet_length("kept") + gone).alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

"""A Merkle manifest of a dataset, with a proof for every row.

Rows are leaves. Their order inside a group comes from bitmaps instead of a sort: every
task sets the bits of the ids it holds, in words of 64 bits of which only those with a bit
are kept, words of a group are merged by OR, and a directory of their popcounts tells how
many rows stand before a word. An id's rank is that count plus the popcount of the lower
bits of its word. Ranks are coordinates: every 512 consecutive leaves form a keyed array of
slots, which is reduced three levels of eight at once, round by round, up to the group's
subroot; subroots are reduced the same way to the root. Paths are handed down again, and
each leaf is folded along its own.

Null ids come first. Rows of one id stand in order of their leaves and equal rows in any;
their ranks come from bitmaps of the leaves' leading bits, and of row numbers, in the same
way, so no group of equal ids meets in one task. An empty table has no root and gives no
rows. A text of any length is hashed as one value of its row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.llm.common import Scratch, lower_ascii

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
LEVELS = 3
SLOTS = ARITY**LEVELS
SLOT_BITS = 9
# A word holds 64 ids; a directory entry stands for at most 2^16 smaller ones.
WORD_BITS = 6
ENTRY_BITS = 16
# Blocks that a task turns into rows at once.
BLOCKS_AT_ONCE = 16
LEAST = -(1 << 63)
NODES = "g string, n long, place long, digest binary"
PATHS = "g string, n long, place long, slots array<int>, siblings array<string>"
BASE = "g string, subroot string, slots array<int>, siblings array<string>"
RESULTS = {
    "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "slots", "siblings"
}


def _field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another: ``-`` for null, else size, colon, value."""
    return F.sha2(F.concat(*[_field(v) for v in values]).cast("binary"), 256)


def _bit(ident: Column) -> Column:
    return ident.bitwiseAND(F.lit(63)).cast("int")


def _shifted(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits)


def _before(counts: DataFrame, by: Sequence[str], bits: int) -> DataFrame:
    """``by``, ``key`` and how many rows the smaller keys of the group hold.

    Entries are summed upwards by their leading bits, so no window is over more than 2^16.
    """
    inside = F.coalesce(
        F.sum("n").over(
            Window.partitionBy(*by, "above").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    above = _shifted(F.col("key"), ENTRY_BITS) if bits > ENTRY_BITS else F.lit(0).cast("long")
    counts = counts.withColumn("above", above)
    ranked = counts.select(*by, "key", "above", inside.alias("inside"))
    if bits <= ENTRY_BITS:
        return ranked.select(*by, "key", F.col("inside").alias("before"))
    sums = counts.groupBy(*by, F.col("above").alias("key")).agg(F.sum("n").alias("n"))
    upper = _before(sums, by, bits - ENTRY_BITS).withColumnRenamed("key", "above")
    joined = ranked.join(upper, [*by, "above"])
    return joined.select(*by, "key", (F.col("inside") + F.col("before")).alias("before"))


def ranked(
    rows: DataFrame, by: Sequence[str], ident: str, scratch: Scratch, name: str
) -> tuple[DataFrame, bool]:
    """The rows with ``place``, how many rows of their group have a smaller ``ident``.

    ``twins`` tells which rows share their ident with another; the second result whether
    there are any. ``by`` and ``ident`` (a long) must not be null.
    """
    key, bit = _shifted(F.col(ident), WORD_BITS), _bit(F.col(ident))
    one, ones = F.lit(1).cast("long"), F.lit(-1).cast("long")
    lower = F.bitwise_not(F.call_function("shiftleft", ones, bit))
    words = rows.groupBy(*by, key.alias("key")).agg(
        F.bit_or(F.call_function("shiftleft", one, bit)).alias("bits"), F.count("*").alias("n")
    )
    words = scratch.write(words, f"{name}-words")
    directory = words.join(_before(words.select(*by, "key", "n"), by, 64 - WORD_BITS), [*by, "key"])
    crowded = words.where(F.col("n") > F.bit_count("bits")).select(*by, "key")
    repeated = not crowded.isEmpty()
    rows = rows.withColumn("key", key)
    place = F.col("before") + F.bit_count(F.col("bits").bitwiseAND(lower))
    twins = F.lit(False)
    if repeated:
        # A word has at most 64 ids, so at most as many counts of further copies.
        counts = rows.join(crowded, [*by, "key"], "left_semi").groupBy(*by, "key", ident)
        counts = counts.agg((F.count("*") - 1).alias("more")).where("more > 0")
        extra = counts.groupBy(*by, "key").agg(
            F.collect_list(F.struct(_bit(F.col(ident)).alias("bit"), "more")).alias("extra")
        )
        directory = directory.join(extra, [*by, "key"], "left")
        less = F.filter("extra", lambda e: e.bit < bit)
        more = F.aggregate(less, F.lit(0).cast("long"), lambda a, e: a + e.more)
        place = place + F.coalesce(more, F.lit(0))
        twins = F.coalesce(F.exists("extra", lambda e: e.bit == bit), F.lit(False))
    columns = [c for c in rows.columns if c != "key"]
    joined = rows.join(directory, [*by, "key"])
    return joined.select(*columns, place.alias("place"), twins.alias("twins")), repeated


def _placed(
    rows: DataFrame, by: Sequence[str], idents: Sequence[str], scratch: Scratch
) -> DataFrame:
    """The rows with their ``place`` in the group, by the first ident, then by the next."""
    first, *rest = idents
    found, repeated = ranked(rows, by, first, scratch, f"by-{first}")
    if not repeated:
        return found.drop("twins")
    start = f"start_{len(by)}"
    tied = found.where("twins").withColumnRenamed("place", start).drop("twins")
    inner = _placed(tied, [*by, first], rest, scratch)
    inner = inner.withColumn("place", F.col(start) + F.col("place")).drop(start)
    return found.where("NOT twins").drop("twins").unionByName(inner)


def _parents(level: list[str]) -> list[str]:
    return [
        hashlib.sha256("".join(level[i : i + ARITY]).encode()).hexdigest()
        for i in range(0, len(level), ARITY)
    ]


def _levels(digests: list[str], n: int) -> list[list[str]]:
    """A block's levels, as many as it has below the next round or the group's top."""
    found = [digests]
    while len(found) <= LEVELS and n > 1:
        found.append(_parents(found[-1]))
        n = -(-n // ARITY)
    return found


def _left(n: int) -> int:
    for _ in range(LEVELS):
        n = -(-n // ARITY)
    return n


def _path(levels: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    """Per level the slot of item ``i`` in its run, and the run's others, joined."""
    slots, siblings = [], []
    for level in levels[:-1]:
        slot = i % ARITY
        run = level[i - slot : i - slot + ARITY]
        slots.append(slot)
        siblings.append("".join(run[:slot] + run[slot + 1 :]))
        i //= ARITY
    return slots, siblings


def _fold(digest: str, slots: Sequence[int], siblings: Sequence[str]) -> str:
    width = 64
    for slot, others in zip(slots, siblings):
        whole = others[: slot * width] + digest + others[slot * width :]
        digest = hashlib.sha256(whole.encode()).hexdigest()
    return digest


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block as one node of the round above."""
    for batch in batches:
        column = {name: batch.column(name) for name in ("g", "n", "block", "items")}
        nodes = []
        for i in range(batch.num_rows):
            n = column["n"][i].as_py()
            digests = [d.hex() for d in column["items"][i].values.field("digest").to_pylist()]
            nodes.append((_left(n), bytes.fromhex(_levels(digests, n)[-1][0])))
        yield pa.record_batch(
            [
                column["g"],
                pa.array([n for n, _ in nodes], pa.int64()),
                column["block"],
                pa.array([d for _, d in nodes], pa.binary()),
            ],
            names=["g", "n", "place", "digest"],
        )


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of every item of a block, below that of the block's node."""
    for batch in batches:
        for row in batch.to_pylist():
            levels = _levels([d["digest"].hex() for d in row["items"]], row["n"])
            found = [_path(levels, i) for i in range(len(row["items"]))]
            size = len(found)
            yield pa.record_batch(
                [
                    pa.array([row["g"]] * size, pa.string()),
                    pa.array([row["n"]] * size, pa.int64()),
                    pa.array([d["place"] for d in row["items"]], pa.int64()),
                    pa.array([s + row["slots"] for s, _ in found], pa.list_(pa.int32())),
                    pa.array([s + row["siblings"] for _, s in found], pa.list_(pa.string())),
                ],
                names=["g", "n", "place", "slots", "siblings"],
            )


def _subroots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every group by name, its subroot and the path from there to the root."""
    for batch in batches:
        for row in batch.to_pylist():
            levels = _levels([d["digest"].hex() for d in row["items"]], row["n"])
            found = [_path(levels, i) for i in range(len(row["items"]))]
            yield pa.record_batch(
                [
                    pa.array([d["group"] for d in row["items"]], pa.string()),
                    pa.array(levels[0], pa.string()),
                    pa.array([s + row["slots"] for s, _ in found], pa.list_(pa.int32())),
                    pa.array([s + row["siblings"] for _, s in found], pa.list_(pa.string())),
                ],
                names=["g", "subroot", "slots", "siblings"],
            )


def _audit(batches: Iterator[pa.RecordBatch], root: str, full: bool) -> Iterator[pa.RecordBatch]:
    """Rows of blocks of leaves: proof, what the row as found folds to, and if that is the root."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCKS_AT_ONCE):
            part = batch.slice(first, BLOCKS_AT_ONCE)
            # A slice's lists are a stretch of the whole batch's values.
            values = part.column("items").flatten()
            out = {k: [] for k in ("leaf", "subroot", "proof_sha256", "folded_root", "slots", "siblings")}
            at = 0
            head = [part.column(c).to_pylist() for c in ("n", "subroot", "slots", "siblings")]
            sizes = part.column("items").value_lengths().to_pylist()
            leaves = [d.hex() for d in values.field("digest").to_pylist()]
            founds = [d and d.hex() for d in values.field("found").to_pylist()]
            for n, subroot, upper_slots, upper, size in zip(*head, sizes):
                levels = _levels(leaves[at : at + size], n)
                for i in range(size):
                    slots, siblings = _path(levels, i)
                    slots, siblings = slots + upper_slots, siblings + upper
                    out["proof_sha256"].append(hashlib.sha256("".join(siblings).encode()).hexdigest())
                    out["folded_root"].append(_fold(founds[at + i] or leaves[at + i], slots, siblings))
                    if full:
                        out["slots"].append(slots)
                        out["siblings"].append(siblings)
                out["subroot"] += [subroot] * size
                at += size
            out["leaf"] = leaves
            columns = {k: pa.array(out[k], pa.string()) for k in ("leaf", "subroot")}
            columns["root"] = pa.array([root] * at, pa.string())
            columns |= {k: pa.array(out[k], pa.string()) for k in ("proof_sha256", "folded_root")}
            columns["verified"] = pa.array([d == root for d in out["folded_root"]], pa.bool_())
            if full:
                columns["slots"] = pa.array(out["slots"], pa.list_(pa.int32()))
                columns["siblings"] = pa.array(out["siblings"], pa.list_(pa.string()))
            kept = values.field("row")
            yield pa.record_batch([kept, *columns.values()], names=["row", *columns])


def _blocks(nodes: DataFrame, *more: str) -> DataFrame:
    """Slot arrays: a row per 512 consecutive nodes, the items in their slots."""
    block = _shifted(F.col("place"), SLOT_BITS).alias("block")
    items = F.sort_array(F.collect_list(F.struct("place", "digest", *more)))
    return nodes.groupBy("g", "n", block).agg(items.alias("items"))


def _climb(
    nodes: DataFrame, scratch: Scratch, name: str, *more: str
) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks up to one node a group, and that node of every group."""
    rounds, tops = [], []
    most = 1
    while not rounds or most > 1:
        blocks = scratch.write(_blocks(nodes, *more), f"{name}-{len(rounds)}")
        rounds.append(blocks)
        digests = F.transform("items", lambda x: F.struct(x.digest.alias("digest")))
        above = blocks.select("g", "n", "block", digests.alias("items")).mapInArrow(_reduce, NODES)
        above = scratch.write(above, f"{name}-{len(rounds)}-nodes")
        tops.append(above.where("n = 1").select("g", "digest"))
        nodes, more = above.where("n > 1"), ()
        most = above.agg(F.max("n")).first()[0] or 0
    return rounds, reduce(DataFrame.unionByName, tops)


def _below(blocks: DataFrame, base: DataFrame, inner: DataFrame | None) -> DataFrame:
    """Blocks with the path of their node: the group's own, or one from the round above."""
    top = blocks.where(F.col("n") <= SLOTS).join(base.select("g", "slots", "siblings"), "g")
    if inner is None:
        return top
    inner = inner.select("g", F.col("place").alias("block"), "slots", "siblings")
    return top.unionByName(blocks.where(F.col("n") > SLOTS).join(inner, ["g", "block"]))


def _handed_down(
    rounds: list[DataFrame], base: DataFrame, scratch: Scratch, name: str
) -> DataFrame:
    """The blocks of the first round with the path of their node."""
    inner = None
    for k in range(len(rounds) - 1, 0, -1):
        paths = _below(rounds[k], base, inner).mapInArrow(_descend, PATHS)
        inner = scratch.write(paths, f"{name}-{k}-paths")
    return _below(rounds[0], base, inner)


def _in_order(tops: DataFrame, scratch: Scratch) -> DataFrame:
    """Subroots as nodes of one more group, in order of their groups' names.

    Ranges of names are sorted by a task each; the driver adds up how many each holds.
    """
    ordered = tops.repartitionByRange("g").sortWithinPartitions("g")
    ordered = scratch.write(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = _shifted(F.col("at"), 33)
    starts, total = {}, 0
    for row in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts[row["part"]] = total
        total += row["count"]
    pairs = [F.lit(x) for item in starts.items() for x in item]
    start = F.element_at(F.create_map(*pairs), part) if pairs else F.lit(0)
    place = (start + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")
    top = F.lit("").alias("g"), F.lit(total).cast("long").alias("n")
    return ordered.select(*top, place.alias("place"), "digest", F.col("g").alias("group"))


@dataclass
class Manifest:
    """``root`` (None for no rows), and ``subroots``: group, rows and subroot of each."""

    root: str | None
    subroots: DataFrame
    _rounds: list[DataFrame]
    _base: DataFrame
    _scratch: Scratch

    def audit(self, full: bool = False) -> DataFrame:
        """A row per leaf: the kept columns, leaf, subroot, root, the digest of its proof,
        what the row as found folds to along the proof, and whether that is the root.

        ``full`` adds the proof: the leaf's slot per level and the others of its run.
        """
        blocks = _handed_down(self._rounds, self._base, self._scratch, "leaves")
        row = blocks.schema["items"].dataType.elementType["row"]
        names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        fields = [row, *[T.StructField(n, T.StringType()) for n in names]]
        fields.append(T.StructField("verified", T.BooleanType()))
        if full:
            fields.append(T.StructField("slots", T.ArrayType(T.IntegerType())))
            fields.append(T.StructField("siblings", T.ArrayType(T.StringType())))
        blocks = blocks.join(self._base.select("g", "subroot"), "g")
        blocks = blocks.select("n", "items", "subroot", "slots", "siblings")
        found = blocks.mapInArrow(partial(_audit, root=self.root, full=full), T.StructType(fields))
        return found.select("row.*", *[f.name for f in fields[1:]])


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    *,
    found: Column | None = None,
    ident: str = "doc_id",
    group: str = "lang",
    keep: Sequence[str] = ("doc_id",),
) -> Manifest:
    """The manifest of ``docs``: hashes of ``fields``, per ``group`` in order of ``ident``.

    ``found`` is the leaf hash of a row as found later, null where that is the row itself.
    """
    taken = {c.lower() for c in docs.select(*keep).columns} & RESULTS
    if taken:
        raise ValueError(f"kept columns {sorted(taken)} have the names of results")
    scratch = Scratch(docs.sparkSession, "manifest")
    leaf = leaf_hash([F.col(f) for f in fields])
    rows = docs.select(
        # Groups by name, null first.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
        F.coalesce(F.col(ident).cast("long"), F.lit(LEAST)).alias("ident"),
        F.unhex(leaf).alias("digest"),
        F.unhex(F.lit(None).cast("string") if found is None else found).alias("found"),
        F.monotonically_increasing_id().alias("number"),
        F.struct(*keep).alias("row"),
    )
    rows = scratch.write(rows, "rows")
    head = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    rows = rows.withColumn("head", head.bitwiseXOR(F.lit(LEAST)))
    sizes = rows.groupBy("g").agg(F.count("*").alias("n"))
    leaves = _placed(rows, ["g"], ["ident", "head", "number"], scratch).join(sizes, "g")
    rounds, tops = _climb(leaves, scratch, "leaves", "found", "row")
    tops = _in_order(tops, scratch)
    top_rounds, root = _climb(tops, scratch, "groups", "group")
    root = root.first()
    start = top_rounds[0].select("g").distinct()
    empty = {"slots": F.array().cast("array<int>"), "siblings": F.array().cast("array<string>")}
    named = _handed_down(top_rounds, start.withColumns(empty), scratch, "groups")
    base = scratch.write(named.mapInArrow(_subroots, BASE), "base")
    shown = F.when(F.col("g") != "", F.substring("g", 2, 2**31 - 1)).alias(group)
    subroots = base.join(sizes, "g").select(shown, F.col("n").alias("rows"), "subroot")
    return Manifest(root and root["digest"].hex(), subroots, rounds, base, scratch)


def audit_lowered(docs: DataFrame) -> DataFrame:
    """The audit of a manifest against its rows with every third text in lower case.

    Those are the rows whose decimal doc_id has a CRC-32 that three divides; a row without
    doc_id, and a null text, stay as they are.
    """
    lowered = [lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in FIELDS]
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return build(docs, found=F.when(third, leaf_hash(lowered))).audit()

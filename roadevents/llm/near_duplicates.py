"""Near duplicates: an exact n-gram Jaccard join with signature trees.

A document is its set of word shingles; documents of one set are one class. Two sets
that meet the threshold share a shingle among the few first of each (their prefixes) in any
order common to all. Here three eighths of all shingles, told by their hash, come first,
the rarest by exact count before the others; that is more than a prefix has, so only these
are counted, and a set whose own shingles fill its prefix is compared with none. Classes
are grouped by the shingles of their prefixes. First every class of a group is compared
with the one of it that a hash puts first, and what is linked is joined to components. Then each group with several components is searched by a signature tree:
leaves are classes with a bitmap of their shingles, nodes hold the bits of any and of all
leaves below and the range of sizes. Two nodes are left aside when no pair below them can
overlap enough, or when all below them is one component. What remains is compared by the
full sets. Links between different sets are never lost, and pairs that are already
connected need not be listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import batched
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.llm.bitmaps import BitMap
from roadevents.llm.common import Scratch, mix64, steps
from roadevents.llm.components import components
from roadevents.llm.wordhash import word_ids

WORDS = 5
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
SIGNATURE = 10
WIDE_BITS = 1 << 14
# Shingles below this come first in the common order: three eighths of them.
FIRST = 3 << 61
# Classes of a group that one task compares with as many others.
BLOCK = 1000
LEAF = 16


def shingles(words: np.ndarray) -> np.ndarray:
    """The sorted distinct shingles; fewer words than one has are one shingle together."""
    width = min(WORDS, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    count = len(words) - width + 1
    value = np.full(count, width, np.uint64)
    for k in range(width):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
    return np.unique(mix64(value))


def linked(inter, n, m):
    """Whether sets of ``n`` and ``m`` with ``inter`` in common meet the threshold."""
    return (100 + PERCENT) * inter >= PERCENT * (n + m)


def _sets(batches: Iterator[pa.RecordBatch]):
    for batch in steps(batches):
        yield batch, [shingles(w) for w in word_ids(batch.column("text").to_pylist())]


def _digest(own: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


INFO = "doc_id bigint, text_id binary, n_shingles bigint, cls binary"


def _info(batches: Iterator[pa.RecordBatch]):
    """A row per document."""
    for batch, sets in _sets(batches):
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("text_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
            ],
            names=[c.split()[0] for c in INFO.split(", ")],
        )


def prefix_size(n):
    """Of so many shingles of a set, in the common order, any linked set has one."""
    return n + PERCENT * -n // 100 + 1


class _Firsts:
    """Tells a class's document of smallest id from the others.

    By chance it lets another one through, which only costs work.
    """

    def __init__(self, info: DataFrame):
        firsts = _first_ids(info).select("doc_id", "cls")
        self.map = BitMap(firsts, lambda b: _Firsts.number(b.column("doc_id"), b.column("cls").to_pylist()))

    @staticmethod
    def number(ids: pa.Array, classes: list[bytes]) -> np.ndarray:
        known = _known(ids).view(np.uint64)
        return (mix64(known) ^ _numbers(classes).view(np.uint64)).view(np.int64)

    def of(self, batch: pa.RecordBatch, sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, bytes]]:
        """The sets, with their classes, of the batch's first documents."""
        rows = [i for i, own in enumerate(sets) if len(own)]
        classes = [_digest(sets[i]) for i in rows]
        first = self.map.has(self.number(batch.column("doc_id").take(pa.array(rows, pa.int64())), classes))
        for i, cls, kept in zip(rows, classes, first, strict=True):
            if kept:
                yield sets[i], cls


BITS = [f"s{i}" for i in range(SIGNATURE)]
# The least tokens of a class's groups, and what stands where it has fewer.
LEAST = [f"m{i}" for i in range(8)]
LAST = 2**63 - 1


def signature(own: np.ndarray) -> np.ndarray:
    """The bits of the set's shingles, as 64-bit words."""
    bits = np.zeros(64 * SIGNATURE, bool)
    bits[(own % np.uint64(64 * SIGNATURE)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


OWN = "cls binary, n bigint, early bigint, tokens array<bigint>, " + ", ".join(f"{s} bigint" for s in BITS)


def _own(batches: Iterator[pa.RecordBatch], firsts: _Firsts):
    """Of each class the shingles that its prefix may have: those that come first, and if
    they are too few, the least of the others."""
    for batch, sets in _sets(batches):
        found = list(firsts.of(batch, sets))
        if not found:
            continue
        early = [int(np.searchsorted(own, np.uint64(FIRST))) for own, _ in found]
        tokens = [own[: max(k, prefix_size(len(own)))] for (own, _), k in zip(found, early)]
        signs = np.stack([signature(own) for own, _ in found])
        ends = np.cumsum([0, *map(len, tokens)])
        yield pa.record_batch(
            [
                pa.array([cls for _, cls in found], pa.binary()),
                pa.array([len(own) for own, _ in found], pa.int64()),
                pa.array(early, pa.int64()),
                pa.ListArray.from_arrays(ends.astype(np.int32), np.concatenate(tokens).view(np.int64)),
                *[pa.array(np.ascontiguousarray(signs[:, i])) for i in range(SIGNATURE)],
            ],
            names=["cls", "n", "early", "tokens", *BITS],
        )


def _members(own: DataFrame, scratch: Scratch) -> DataFrame:
    """token, cls, n, the bits of each class in the groups of its prefix, ``odd``, the
    share of its shingles that no other class has, and the least tokens of its groups.

    Such a shingle fills a place of the prefix and makes no group.
    """
    tokens = own.select("id", F.explode("tokens").alias("token"))
    counted = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    late = ~F.col("token").between(0, FIRST - 1)
    entry = F.struct(late.alias("late"), "df", "token")
    shared = tokens.join(counted, "token").groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("shared"))
    # Early shingles stand before late ones, so the first places are theirs.
    many = F.size("shared") - F.size(F.filter("shared", lambda x: x.late))
    size = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    alone = F.col("early") - many
    free = F.greatest(size - alone, F.lit(0)).cast("int")
    early = F.slice("shared", F.lit(1), F.least(free, many))
    kept = F.concat(early, F.filter("shared", lambda x: x.late))
    each = own.drop("tokens").join(shared, "id")
    each = each.withColumns({"kept": kept, "odd": alone / F.col("n")})
    each = each.select(F.col("kept.token").alias("kept"), "id", "cls", "n", "odd", *BITS)
    each = scratch.write(each.where(F.size("kept") > 0), "prefixes")
    groups = scratch.write(_distinct_groups(each.select("id", F.explode("kept").alias("token"))), "groups")
    own_groups = F.sort_array(F.collect_list("token"))
    least = groups.groupBy("id").agg(own_groups.alias("own"))
    least = least.select("id", *[F.coalesce(F.get("own", F.lit(i)), F.lit(LAST)).alias(m) for i, m in enumerate(LEAST)])
    return groups.join(each.drop("kept"), "id").join(least, "id").drop("id")


def _distinct_groups(rows: DataFrame) -> DataFrame:
    """The rows (id, token) of the groups of several ids, one token for every set of ids.

    Copies of a long text share all they have: so many groups of the same classes give
    the same pairs. Sets are told apart by their sizes and 128 bits of their ids' hashes.
    """
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), "id")).alias(f"h{seed}") for seed in (1, 2)]
    groups = rows.groupBy("token").agg(F.count("*").alias("size"), *hashes).where("size > 1")
    tokens = groups.groupBy("size", "h1", "h2").agg(F.min("token").alias("token")).select("token")
    return rows.join(tokens, "token").select("id", "token")


def _may_link(one: str, other: str) -> Column:
    """Whether two classes can meet the threshold, by sizes and bitmaps."""

    def reach(a: str, b: str) -> Column:
        missing = [
            F.bit_count(F.col(f"{a}.{s}").bitwiseAND(F.bitwise_not(F.col(f"{b}.{s}")))) for s in BITS
        ]
        return F.col(f"{a}.n") - reduce(add, missing)

    least = F.least(reach(one, other), reach(other, one))
    return linked(least, F.col(f"{one}.n"), F.col(f"{other}.n"))


def _stars(members: DataFrame) -> DataFrame:
    """Each class of a group with that which has the least of its own, so it is likely to be
    what the others were made from; groups of the same classes give the same pairs."""
    chance = F.xxhash64("cls")
    lead = F.min(F.struct("odd", chance.alias("chance"), "cls", "n", *BITS)).alias("lead")
    leads = members.groupBy("token").agg(lead).select("token", "lead.*")
    both = members.alias("m").join(leads.alias("l"), "token")
    pairs = both.where((F.col("m.cls") != F.col("l.cls")) & _may_link("m", "l"))
    return pairs.select(
        F.least("m.cls", "l.cls").alias("a"), F.greatest("m.cls", "l.cls").alias("b")
    ).distinct()


class _Tree:
    """A node: what any and all of its classes' bitmaps have, sizes, one component or -1."""

    def __init__(self, rows: np.ndarray, bits: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        self.rows = rows
        own = bits[rows]
        self.any, self.all = np.bitwise_or.reduce(own), np.bitwise_and.reduce(own)
        self.low, self.high = int(sizes[rows].min()), int(sizes[rows].max())
        first = comps[rows[0]]
        self.comp = int(first) if (comps[rows] == first).all() else -1
        self.below: list[_Tree] = []
        if len(rows) > LEAF:
            order = self._order(own, sizes[rows])
            half = len(rows) // 2
            self.below = [
                _Tree(rows[order[:half]], bits, sizes, comps),
                _Tree(rows[order[half:]], bits, sizes, comps),
            ]

    def _order(self, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Classes with and without the bit that parts them most evenly, then by size."""
        bits = np.unpackbits(own.view(np.uint8), axis=1)
        part = np.argmin(np.abs(bits.mean(axis=0) - 0.5))
        return np.lexsort((sizes, bits[:, part]))


def _apart(a: _Tree, b: _Tree) -> bool:
    """Whether no class of ``a`` needs to meet one of ``b``."""
    if a.comp == b.comp != -1:
        return True
    over = int(np.bitwise_count(a.all & ~b.any).sum())
    under = int(np.bitwise_count(b.all & ~a.any).sum())
    most = min(a.high - over, b.high - under)
    return not linked(most, a.low, b.low)


def tree_pairs(
    bits: np.ndarray, sizes: np.ndarray, comps: np.ndarray, left: np.ndarray, right: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Pairs of classes, one in ``left`` and one in ``right`` (places), of different
    components that may meet the threshold. Equal sides give each pair once."""
    one = _Tree(left, bits, sizes, comps)
    same = left is right
    waiting = [(one, one if same else _Tree(right, bits, sizes, comps))]
    while waiting:
        a, b = waiting.pop()
        if _apart(a, b):
            continue
        if a.below or b.below:
            parts_a, parts_b = a.below or [a], b.below or [b]
            if a is b:
                first, second = parts_a
                waiting += [(first, first), (first, second), (second, second)]
            else:
                waiting += [(x, y) for x in parts_a for y in parts_b]
            continue
        x, y = bits[a.rows][:, None], bits[b.rows][None]
        n, m = sizes[a.rows][:, None], sizes[b.rows][None]
        over = np.bitwise_count(x & ~y).sum(axis=2).astype(np.int64)
        under = np.bitwise_count(y & ~x).sum(axis=2).astype(np.int64)
        may = linked(np.minimum(n - over, m - under), n, m)
        may &= comps[a.rows][:, None] != comps[b.rows][None]
        for i, j in zip(*np.nonzero(may), strict=True):
            if a is not b or i < j:
                yield int(a.rows[i]), int(b.rows[j])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of sorted groups, one group, or two blocks of a large one, at a time."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        ends = _ends(held)
        # The last group may go on in the next batch.
        if len(ends) > 1:
            yield _pairs(held.slice(0, ends[-2]), ends[:-1])
            held = held.slice(ends[-2]).combine_chunks()
    if held is not None and len(held):
        yield _pairs(held, _ends(held))


def _ends(rows: pa.Table) -> np.ndarray:
    keys = np.stack([rows.column(c).to_numpy() for c in ("token", "i", "j")])
    return np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, len(rows))


def _pairs(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
    bits = np.stack([rows.column(s).to_numpy() for s in BITS], axis=1).view(np.uint64)
    sizes, side = rows.column("n").to_numpy(), rows.column("side").to_numpy()
    across, tokens = rows.column("across").to_numpy(), rows.column("token").to_numpy()
    least = np.stack([rows.column(m).to_numpy() for m in LEAST], axis=1)
    names = rows.column("cls").to_pylist()
    comps = pd.factorize(np.array(rows.column("comp").to_pylist(), object))[0]
    classes = pd.factorize(np.array(names, object))[0]
    one, other, at = [], [], 0
    for end in ends.tolist():
        own, at = np.arange(at, end), end
        if (comps[own] == comps[own[0]]).all():
            continue
        # Copies of a class that came by chance stand for it once.
        own = own[np.unique(classes[own] * 2 + side[own], return_index=True)[1]]
        left, right = own[side[own] == 0], own[side[own] == 1]
        if not across[own[0]]:
            right = left
        if not len(left) or not len(right):
            continue
        for pairs in batched(tree_pairs(bits, sizes, comps, left, right), 10_000):
            x, y = np.array(pairs).T
            new = ~_met(least[x], least[y], tokens[own[0]])
            for i, j in zip(x[new].tolist(), y[new].tolist(), strict=True):
                one.append(min(names[i], names[j]))
                other.append(max(names[i], names[j]))
    return pa.record_batch({"a": pa.array(one, pa.binary()), "b": pa.array(other, pa.binary())})


def _met(one: np.ndarray, other: np.ndarray, token: int) -> np.ndarray:
    """Which pairs have a token below this one in common, of the least of each."""
    found = np.zeros(len(one), bool)
    for k in range(len(LEAST)):
        found |= (one[:, k] < token) & (one[:, k, None] == other).any(axis=1)
    return found


def _searched(members: DataFrame, comps: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidate pairs between components, from every group that has several.

    A group of many classes is dealt in blocks; each pair of blocks is one task's work.
    Groups of two were settled by their star. A pair that is seen to share another group of
    a smaller token is left to that one, which is searched or settled too.
    """
    comp = F.coalesce("comp", "cls")
    several = members.select("token", "cls").join(comps, "cls", "left").groupBy("token").agg(
        F.min(comp).alias("low"), F.max(comp).alias("high"), F.count("*").alias("size")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    several = several.where("low != high AND size > 2").select("token", blocks)
    several = scratch.write(several, "several")
    own = members.join(several, "token").join(comps, "cls", "left").withColumn("comp", comp)
    dealt = own.withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
    # A class goes to each pair of blocks that its own is in.
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = dealt.withColumn("other", F.explode(every)).select(
        "token",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
        (F.col("block") != F.col("other")).alias("across"),
        "cls",
        "comp",
        "n",
        *BITS,
        *LEAST,
    )
    groups = ("token", "i", "j")
    dealt = dealt.repartition(*groups).sortWithinPartitions(*groups)
    return dealt.mapInArrow(_search, "a binary, b binary").distinct()


def _known(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(-(2**63)).to_numpy()


def _wanted(
    batches: Iterator[pa.RecordBatch], documents: BitMap, wanted: BitMap, firsts: _Firsts
):
    # By their ids most texts are left aside before they are read.
    some = (b.filter(pa.array(documents.has(_known(b.column("doc_id"))))) for b in batches)
    for batch, sets in _sets(some):
        some = [(cls, own) for own, cls in firsts.of(batch, sets)]
        if some:
            kept = wanted.has(_numbers([d for d, _ in some]))
            some = [s for s, k in zip(some, kept, strict=True) if k]
        yield pa.record_batch(
            {
                "cls": pa.array([d for d, _ in some], pa.binary()),
                "n": pa.array([len(own) for _, own in some], pa.int64()),
                "wide": pa.array([wide(own) for _, own in some], pa.binary()),
                "own": pa.array([own.tobytes() for _, own in some], pa.binary()),
            }
        )


def _numbers(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), np.int64)


def wide(own: np.ndarray) -> bytes:
    """A bitmap of the set that stays sparse for sets of some thousand shingles."""
    bits = np.zeros(WIDE_BITS, bool)
    bits[(own >> np.uint64(20) & np.uint64(WIDE_BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _possible(batches: Iterator[pa.RecordBatch]):
    """The pairs whose wide bitmaps do not rule them out."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("one", "other", "n", "m")]
        kept = []
        for one, other, n, m in zip(*columns, strict=True):
            x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            over = int(np.bitwise_count(x & ~y).sum())
            under = int(np.bitwise_count(y & ~x).sum())
            kept.append(bool(linked(min(n - over, m - under), n, m)))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _verified(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("one", "other")]
        kept = []
        for one, other in zip(*columns, strict=True):
            x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            kept.append(bool(linked(both, len(x), len(y))))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _links(
    rows: DataFrame, info: DataFrame, firsts, pairs: DataFrame, scratch: Scratch, step: str
) -> DataFrame:
    """The pairs whose full sets meet the threshold."""
    names = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    names = scratch.write(names.join(_first_ids(info), "cls"), f"names-{step}")
    wanted = BitMap(names.select("cls"), lambda b: _numbers(b.column(0).to_pylist()))
    documents = BitMap(names.select(F.coalesce("doc_id", F.lit(-(2**63)))))
    sent = rows.sparkSession.sparkContext.broadcast((documents, wanted))
    # A class that has two documents here, by chance, only has its pairs verified twice.
    sets = rows.mapInArrow(
        lambda b: _wanted(b, *sent.value, firsts.value),
        "cls binary, n bigint, wide binary, own binary",
    )
    sets = scratch.write(sets, f"sets-{step}")
    # Wide bitmaps are smaller than the sets and leave few pairs whose sets must meet.
    one = sets.select(F.col("cls").alias("a"), "n", F.col("wide").alias("one"))
    other = sets.select(F.col("cls").alias("b"), F.col("n").alias("m"), F.col("wide").alias("other"))
    pairs = pairs.join(one, "a").join(other, "b").select("a", "b", "n", "m", "one", "other")
    pairs = scratch.write(pairs.mapInArrow(_possible, "a binary, b binary"), f"possible-{step}")
    one = sets.select(F.col("cls").alias("a"), F.col("own").alias("one"))
    other = sets.select(F.col("cls").alias("b"), F.col("own").alias("other"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    links = scratch.write(both.mapInArrow(_verified, "a binary, b binary"), f"links-{step}")
    sent.unpersist()
    scratch.drop(f"sets-{step}", f"possible-{step}", f"names-{step}")
    return links


def _first_ids(info: DataFrame) -> DataFrame:
    """Of every class the smallest doc_id; null only where it has no other."""
    return info.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))


def _grouped(docs: DataFrame, text: str, text_id: Column) -> DataFrame:
    """doc_id, ``text_id``, n_shingles and component of every row; null without words."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "near-duplicates")
    send = spark.sparkContext.broadcast
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = docs.select("doc_id", text_id.alias("text_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    info = scratch.write(named.mapInArrow(_info, INFO), "info")
    firsts = send(_Firsts(info))
    own = rows.mapInArrow(lambda b: _own(b, firsts.value), OWN)
    own = scratch.write(own.withColumn("id", F.monotonically_increasing_id()), "own")
    members = scratch.write(_members(own, scratch), "members")
    scratch.drop("own", "prefixes", "groups")

    stars = scratch.write(_stars(members), "stars")
    links = _links(rows, info, firsts, stars, scratch, "stars")
    comps = scratch.write(components(links, scratch, "first"), "components")
    found = scratch.write(_searched(members, comps, scratch).join(stars, ["a", "b"], "left_anti"), "found")
    scratch.drop("members", "stars", "several")
    more = _links(rows, info, firsts, found, scratch, "found")
    scratch.drop("found")
    comps = scratch.write(components(links.unionByName(more), scratch, "second"), "result")

    each = info.select("doc_id", "text_id", "n_shingles", "cls")
    return each.join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    ``component_id`` is the smallest doc_id that links lead to. Rows of equal sets are
    linked. A text without words, or null, has no set, no links and its own doc_id.
    Null doc_ids are in components but never name one that has another id. Repeated rows
    each have a row; other columns are left out. A text of any length is read whole, one at
    least at a time. An empty table gives no rows.
    """
    each = _grouped(docs, text, F.lit(None).cast("binary"))
    names = each.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return each.join(names, "comp", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def representatives(docs: DataFrame, text: str = "text", text_id: str = "text_id") -> DataFrame:
    """The distinct keys (doc_id, ``text_id``) of the rows that stay, one of each component.

    It is the smallest doc_id, a null one last, then the smallest ``text_id``, which is a
    digest of the row's text. A text without words has no component, so its key stays.
    """
    each = _grouped(docs, text, F.col(f"`{text_id}`"))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_id")
    least = each.where("comp IS NOT NULL").groupBy("comp").agg(F.min(key).alias("key"))
    alone = each.where("comp IS NULL").select("doc_id", "text_id")
    return least.select("key.doc_id", "key.text_id").unionByName(alone).distinct()

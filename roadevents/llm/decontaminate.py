"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of words. Seeds, runs of ``shortest`` words,
join the two sides. For a document and an item that share seeds, tiling marks the longest
match of unmarked words on both sides, again and again down to ``shortest`` words. The
tiles do not overlap and may stand in any order, so a reordered passage is covered as
well as a plain one. A document is contaminated by an item when the tiles cover at least
``threshold`` of the item's words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import mix64, steps
from roadevents.llm.wordhash import word_ids

SHORTEST = 4
THRESHOLD = 0.5
# Benchmark words in one pass over the documents: the size of what is broadcast.
BLOCK_WORDS = 1 << 20

COLUMNS = "item_id bigint, n_words int, covered int, longest int, tiles int, coverage double"


def seeds(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin values of the runs of ``length`` words, by where they start."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    value = np.zeros(count, np.uint64)
    for k in range(length):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
    return mix64(value)


def tile(
    item: list[int], doc: list[int], pairs: list[tuple[int, int]], shortest: int
) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in doc, length), the longest first.

    ``pairs`` are the starts of all shared seeds. Equal lengths go to the earliest start
    in the item, then in the document.
    """
    # Seeds that follow each other are one maximal match.
    known, matches = set(pairs), []
    for i, j in sorted(known):
        if (i - 1, j - 1) in known:
            continue
        n = 1
        while (i + n, j + n) in known:
            n += 1
        matches.append((i, j, n + shortest - 1))
    used_i, used_j = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    waiting: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, j, n in matches:
        waiting[n].append((i, j))
    tiles = []
    for length in range(max(waiting, default=0), shortest - 1, -1):
        for i, j in sorted(waiting.pop(length, ())):
            taken = used_i[i : i + length] | used_j[j : j + length]
            if not taken.any():
                tiles.append((i, j, length))
                used_i[i : i + length] = used_j[j : j + length] = True
                continue
            # What is left between marked words waits for its own length.
            edges = np.flatnonzero(np.diff(np.concatenate(([1], taken, [1]))))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if b - a >= shortest:
                    waiting[b - a].append((i + a, j + a))
    return tiles


class _Items:
    """One block of the benchmark, with its seeds sorted."""

    def __init__(self, rows: list[tuple[int, str]], shortest: int):
        ids = [i for i, _ in rows]
        sequences = word_ids([t for _, t in rows])
        self.rows = [(i, w.tolist()) for i, w in zip(ids, sequences, strict=True)]
        self.sizes = np.array([len(w) for w in sequences], np.int64)
        found = [seeds(w, shortest) for w in sequences]
        value = np.concatenate(found) if found else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
        start = np.concatenate([np.arange(len(f)) for f in found] or [owner])
        order = np.argsort(value, kind="stable")
        self.values, self.owner, self.start = value[order], owner[order], start[order]


def _covering(words: np.ndarray, items: _Items, shortest: int, threshold: float):
    """Each item that the document covers: its number and tiles.

    First only the places of items that the document shares are looked at, each once
    however often the document has their seeds. Items whose shared seeds reach far enough
    are tiled, one at a time.
    """
    own = seeds(words, shortest)
    low = np.searchsorted(items.values, own, "left")
    hits = items.values[np.minimum(low, len(items.values) - 1)] == own
    if not hits.any():
        return
    distinct, first = np.unique(own[hits], return_index=True)
    low = low[hits][first]
    sizes = np.searchsorted(items.values, distinct, "right") - low
    # The shared places: the stretches of the sorted seeds, one after another.
    ends = np.cumsum(sizes)
    shared = np.arange(ends[-1]) + np.repeat(low - (ends - sizes), sizes)
    shared = shared[np.lexsort((items.start[shared], items.owner[shared]))]
    owner, start = items.owner[shared], items.start[shared]
    follows = np.append(owner[1:] == owner[:-1], False)
    reach = np.where(follows, np.minimum(np.append(np.diff(start), 0), shortest), shortest)
    begin = np.flatnonzero(np.append(True, ~follows[:-1]))
    # No tiling covers more of an item than its shared seeds do.
    covered = np.add.reduceat(reach, begin)
    enough = covered >= threshold * items.sizes[owner[begin]]
    if not enough.any():
        return
    doc, order = words.tolist(), np.argsort(own, kind="stable")
    ordered = own[order]
    for i in np.flatnonzero(enough).tolist():
        places = shared[begin[i] : begin[i + 1] if i + 1 < len(begin) else len(shared)]
        values = items.values[places]
        first = np.searchsorted(ordered, values, "left").tolist()
        last = np.searchsorted(ordered, values, "right").tolist()
        pairs = [
            (place, at)
            for place, a, z in zip(items.start[places].tolist(), first, last, strict=True)
            for at in order[a:z].tolist()
        ]
        number = int(owner[begin[i]])
        item = items.rows[number][1]
        tiles = tile(item, doc, pairs, shortest)
        if sum(n for _, _, n in tiles) >= threshold * len(item):
            yield number, tiles


def _found(
    batches: Iterator[pa.RecordBatch],
    items: _Items,
    shortest: int,
    threshold: float,
    arrow: pa.Schema,
):
    for batch in steps(batches, "__text"):
        out: dict[str, list] = {name: [] for name in arrow.names}
        for row, words in enumerate(word_ids(batch.column("__text").to_pylist())):
            for owner, tiles in _covering(words, items, shortest, threshold):
                item_id, item = items.rows[owner]
                covered = sum(n for _, _, n in tiles)
                for name, column in zip(batch.schema.names[:-1], batch.columns, strict=False):
                    out[name].append(column[row].as_py())
                out["item_id"].append(item_id)
                out["n_words"].append(len(item))
                out["covered"].append(covered)
                out["longest"].append(tiles[0][2])
                out["tiles"].append(len(tiles))
                out["coverage"].append(covered / len(item))
        yield pa.RecordBatch.from_pydict(out, arrow)


def _blocks(benchmark: DataFrame, words: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of about ``words`` words each, one part at a time."""
    block, held = [], 0
    for row in benchmark.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        held += len(row["text"].split())
        if held >= words:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    shortest: int = SHORTEST,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and item that it covers: ``keep``, item_id and the tiling.

    Words are what stands between white space, A-Z in lower case. Items with fewer than
    ``shortest`` words, null and empty texts match nothing; equal documents and equal
    items each have their rows. A text of any length is read whole, one at least at a
    time, and holds no more than the places of a block that it shares. An empty table gives
    no rows. The benchmark is read in blocks of ``block_words`` words,
    each of which meets all documents in one pass, so that no broadcast is larger.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*kept.schema.fields, *StructType.fromDDL(COLUMNS).fields])
    if len({f.name for f in schema}) < len(schema):
        raise ValueError("kept columns clash with the result's")
    arrow = to_arrow_schema(schema)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    rows = rows.where(F.col("__text").isNotNull())
    known = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull())
    result = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(known, block_words):
        items = _Items(block, shortest)
        if not len(items.values):
            continue
        shared = docs.sparkSession.sparkContext.broadcast(items)
        part = rows.mapInArrow(
            lambda b, shared=shared: _found(b, shared.value, shortest, threshold, arrow), schema
        )
        result = result.unionByName(part)
    return result


def uncontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    shortest: int = SHORTEST,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs``, all columns, that no item of the benchmark covers.

    As ``contaminated`` decides; rows without text stay.
    """

    def clean(batches: Iterator[pa.RecordBatch], items: _Items):
        for batch in steps(batches, text):
            found = word_ids(batch.column(text).to_pylist())
            free = [not any(_covering(w, items, shortest, threshold)) for w in found]
            yield batch.filter(pa.array(free, pa.bool_()))

    known = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull())
    for block in _blocks(known, block_words):
        items = _Items(block, shortest)
        if len(items.values):
            shared = docs.sparkSession.sparkContext.broadcast(items)
            docs = docs.mapInArrow(lambda b, shared=shared: clean(b, shared.value), docs.schema)
    return docs

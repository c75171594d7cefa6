"""Phrase collocations from sorted count streams.

Every word starts one window: itself and up to four words after it in its piece. Tasks
combine equal windows of a stretch of text and send each with its count to the task of its
range. Sorted there, the windows are one stream in prefix order: all occurrences of a
phrase stand next to each other, so one pass counts the phrases of every length by the
lengths of their runs, and a run that goes on in the next range is added up from its parts.
The ranges' bounds are chosen from a sample and only even out the tasks.

The frequent phrases, at most five in a hundred words, are then kept in two orders. Merged
with the phrases a word shorter, the stream in order of all words but the last gives the
counts of left parts, and that in order of all but the first those of right parts; both
give each shorter phrase its extensions. Counts are exact. Nothing depends on how texts
fall into stretches and ranges.

Null texts are empty; null languages are ``und``. Equal rows count each. Texts of any
length are read in stretches that look ahead over their end. An empty table, or one
without frequent phrases, gives no rows.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadevents.llm.common import Scratch

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
# Bytes of text whose windows are combined at once.
STRETCH = 4 << 20
# Texts that the bounds of the ranges are chosen from, the share of their windows, how many
# at most, and the bytes of a bound.
SAMPLED_TEXTS = 2000
SAMPLED_SHARE = 1 / 64
SAMPLED_WINDOWS = 20_000
BOUND_BYTES = 64
# Rows of the sorted stream that are looked at together.
ROWS = 1 << 16
# Parts in which each language's best phrases are found before they are ranked.
PARTS = 64

_BREAK, _GAP = ord("\n"), ord(" ")
_CLEAN = bytes.maketrans(
    (string.ascii_uppercase + "\t" + ".,;:!?\x0b\x0c\r").encode(),
    (string.ascii_lowercase + " " + "\n" * 9).encode(),
)
_SEPARATOR = re.compile(rb"[ \n]")

WINDOWS = "lang string, words string, n long, part int"
Bounds = list[tuple[bytes, bytes]]
RUNS = "lang string, size int, phrase string, n long"


def _stretches(data: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a cleaned text, each with the next words of its last piece behind it.

    The number tells where the part's own words end.
    """
    ahead = re.compile(rb"(?: *[^ \n]+){0,%d}" % (longest - 1))
    start = 0
    while start < len(data):
        cut = _SEPARATOR.search(data, start + STRETCH)
        end = cut.start() if cut else len(data)
        yield data[start : ahead.match(data, end).end()], end - start
        start = end


def _combined(data: bytes, own: int, longest: int) -> tuple[pa.Array, np.ndarray] | None:
    """The distinct windows of a stretch in byte order, every word with a space behind it,
    and their counts."""
    chars = np.frombuffer(data, np.uint8)
    inside = (chars != _BREAK) & (chars != _GAP)
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    first = int(np.searchsorted(starts, own))
    if not first:
        return None
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    body = [None, pa.py_buffer(offsets), pa.py_buffer(chars[inside])]
    words = pa.Array.from_buffers(pa.binary(), len(starts), body).dictionary_encode()
    # With the space, no word begins another, so windows have the order of their words.
    spaced = pc.binary_join_element_wise(words.dictionary, b"", b" ")
    order = pc.sort_indices(spaced).to_numpy()
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.arange(1, len(order) + 1)
    ids = rank[words.indices.to_numpy()]
    piece = np.searchsorted(np.flatnonzero(chars == _BREAK), starts)
    columns = [ids[:first]]
    for j in range(1, longest):
        column = np.zeros(len(ids), np.uint64)
        column[:-j] = np.where(piece[j:] == piece[:-j], ids[j:], 0)
        columns.append(column[:first])
    bits = len(order).bit_length()
    keys = []
    for at in range(0, longest, 64 // bits):
        key = np.zeros(first, np.uint64)
        for column in columns[at : at + 64 // bits]:
            key = (key << np.uint64(bits)) | column
        keys.append(key)
    places = np.lexsort(keys[::-1])
    new = np.zeros(first, bool)
    new[0] = True
    for key in keys:
        key = key[places]
        new[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(new)
    spaced = pa.concat_arrays([pa.array([b""], pa.binary()), spaced.take(order)])
    parts = [spaced.take(pa.array(column[places[at]])) for column in columns]
    return pc.binary_join_element_wise(*parts, b""), np.diff(at, append=first)


def _range_of(bounds: Bounds, lang: bytes, windows: pa.Array) -> np.ndarray:
    """How many bounds each of the sorted windows has reached."""
    first = bisect_left(bounds, (lang, b""))
    last = bisect_left(bounds, (lang + b"\0", b""))
    size = len(windows)
    at = [bisect_left(range(size), words, key=lambda i: windows[i].as_py()) for _, words in bounds[first:last]]
    return first + np.searchsorted(at, np.arange(size), side="right")


def _windows(
    batches: Iterable[pa.RecordBatch], longest: int, bounds: Bounds
) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            for data, own in _stretches(b"\n".join(texts), longest):
                found = _combined(data, own, longest)
                if found:
                    words, n = found
                    columns = [
                        pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32))),
                        words.cast(pa.string()),
                        pa.array(n, pa.int64()),
                        pa.array(_range_of(bounds, lang.encode(), words), pa.int32()),
                    ]
                    yield pa.record_batch(columns, names=["lang", "words", "n", "part"])
        held.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            if text:
                held.setdefault(lang, []).append(text.translate(_CLEAN))
                size += len(text)
                if size >= STRETCH:
                    yield from flush()
                    size = 0
    yield from flush()


def windows(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    bounds: Bounds | None = None,
) -> DataFrame:
    """lang, words, n and the range by ``bounds``: windows, which may come in several rows."""
    if not 1 < longest <= 6:
        raise ValueError("phrases have 2 to 6 words at most")
    named = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")
    )
    return named.mapInArrow(partial(_windows, longest=longest, bounds=bounds or []), WINDOWS)


def _bounds(docs: DataFrame, text: str, lang: str, longest: int, parts: int) -> Bounds:
    """Bounds of about equal ranges, from the windows of some texts."""
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    share = min(1.0, SAMPLED_TEXTS / max(1, rows.count()))
    found = windows(rows.sample(share, seed=1), longest=longest).sample(SAMPLED_SHARE, seed=2)
    key = F.substring(F.col("words").cast("binary"), 1, BOUND_BYTES).alias("words")
    some = found.orderBy(F.xxhash64("lang", "words")).limit(SAMPLED_WINDOWS)
    keys = [(r["lang"].encode(), bytes(r["words"])) for r in some.select("lang", key).collect()]
    keys.sort()
    picked = [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []
    return sorted(set(picked))


def stream(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST
) -> DataFrame:
    """lang, words and n of all windows in prefix order, by ranges over the partitions."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = windows(docs, text, lang, longest, _bounds(docs, text, lang, longest, parts))
    dealt = found.repartitionById(parts, "part").drop("part")
    return dealt.sortWithinPartitions("lang", "words")


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _codes(words: pa.Array, longest: int) -> list[np.ndarray]:
    """Per place in the window a number for each row's word there, -1 for none."""
    lists = pc.split_pattern(words, " ")
    starts = lists.offsets.to_numpy()
    numbers = lists.values.dictionary_encode().indices.to_numpy()
    sizes = np.diff(starts) - 1  # a space stands behind the last word, too
    starts = starts[:-1]
    return [
        np.where(sizes > k, numbers[np.minimum(starts + k, len(numbers) - 1)], -1)
        for k in range(longest)
    ]


def _first(words: str, size: int) -> str:
    return " ".join(words.split(" ", size)[:size])


def _runs(batches: Iterable[pa.RecordBatch], longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of phrases from a part of the stream in prefix order.

    Runs inside the part are whole, so the rare ones go; a run that touches an end of the
    part is given however rare. Size 0 gives the words of each language.
    """
    # The last row so far, the sums of the runs that it is in, by size, and which of these
    # began with the part.
    last: tuple[str, str] | None = None
    sums, begun = [0] * longest, [True] * longest

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int32(), pa.string(), pa.int64())
        columns = zip(*rows) if rows else ([],) * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.record_batch(arrays, names=["lang", "size", "phrase", "n"])

    for table in _gathered(batches):
        langs, words = (table.column(c).combine_chunks() for c in ("lang", "words"))
        n = table.column("n").to_numpy()
        if last:
            langs = pa.concat_arrays([pa.array([last[0]], pa.string()), langs])
            words = pa.concat_arrays([pa.array([last[1]], pa.string()), words])
            n = np.concatenate([[0], n])
        rows = []
        numbers = langs.dictionary_encode().indices.to_numpy()
        same = numbers[1:] == numbers[:-1]
        new = np.flatnonzero(np.concatenate([[True], ~same]))
        for at, total in zip(new.tolist(), np.add.reduceat(n, new).tolist()):
            rows.append((langs[at].as_py(), 0, "", total))
        for k, codes in enumerate(_codes(words, longest)):
            there = codes >= 0
            same = same & there[1:] & (codes[1:] == codes[:-1])
            start = there.copy()
            start[1:] &= ~same
            at = np.flatnonzero(start)
            if not len(at):
                sums[k], begun[k] = 0, False
                continue
            totals = np.add.reduceat(np.where(there, n, 0), at)
            if at[0] == 0:
                totals[0] += sums[k]
            goes_on = bool(there[-1])
            closed = len(at) - goes_on
            frequent = totals[:closed] >= least
            if closed and begun[k] and at[0] == 0:
                frequent[0] = True
            for i in np.flatnonzero(frequent).tolist():
                row = int(at[i])
                rows.append((langs[row].as_py(), k + 1, _first(words[row].as_py(), k + 1), int(totals[i])))
            sums[k] = int(totals[-1]) if goes_on else 0
            begun[k] = begun[k] and goes_on and len(at) == 1 and at[0] == 0
        last = (langs[-1].as_py(), words[-1].as_py())
        yield batch(rows)
    if last:
        yield batch([(last[0], k + 1, _first(last[1], k + 1), s) for k, s in enumerate(sums) if s])


def counts(ordered: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, size, phrase and n of all phrases with ``n >= least``; size 0: all words."""
    runs = ordered.mapInArrow(partial(_runs, longest=longest, least=least), RUNS)
    whole = runs.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return whole.where((F.col("size") == 0) | (F.col("n") >= least))


def _head() -> Column:
    return F.expr("substring_index(phrase, ' ', size - 1)")


def _tail() -> Column:
    return F.expr("substr(phrase, instr(phrase, ' ') + 1)")


def _merged(stream: DataFrame, key: str, shorter: DataFrame, name: str, counted: Column) -> DataFrame:
    """The stream in order of ``key``, merged with the phrases that are its keys.

    The parts of a frequent phrase are as frequent, so every key is found.
    """
    found = shorter.select("lang", F.col("phrase").alias(key), counted.alias(name))
    return stream.hint("merge").join(found.hint("merge"), ["lang", key])


def parts(counted: DataFrame, scratch: Scratch, longest: int = LONGEST) -> DataFrame:
    """lang, size, phrase, n, the counts of its first 1, 2, ... words as ``left``, of what
    follows these as ``right``, and ``extended``: the largest count of a phrase of one word
    more that holds it, if there is one."""
    none = F.array().cast("array<long>")
    shorter = counted.where("size = 1").select("lang", "phrase", "n", none.alias("left"), none.alias("right"))
    orders = []
    for size in range(2, longest + 1):
        stream = counted.where(F.col("size") == size)
        stream = stream.withColumns({"head": _head(), "tail": _tail()})
        stream = _merged(stream, "head", shorter, "left", F.concat("left", F.array("n")))
        stream = _merged(stream, "tail", shorter, "right", F.concat(F.array("n"), "right"))
        stream = scratch.write(stream, f"words-{size}")
        orders.append(stream)
        shorter = stream.select("lang", "phrase", "n", "left", "right")
    found = []
    for stream, longer in zip(orders, [*orders[1:], None]):
        kept = stream.select("lang", "size", "phrase", "n", "left", "right")
        if longer is None:
            found.append(kept.withColumn("extended", F.lit(None).cast("long")))
            continue
        within = longer.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), F.col("n").alias("m"))
        within = within.groupBy("lang", "phrase").agg(F.max("m").alias("extended"))
        found.append(kept.hint("merge").join(within.hint("merge"), ["lang", "phrase"], "left"))
    return reduce(DataFrame.unionByName, found)


def _weakest() -> Column:
    """The cut with the lowest score, the first of equal ones."""
    # Whole decimals of 38 digits hold every product exactly.
    score = "1000 * CAST(a AS decimal(18, 0)) * CAST(n AS decimal(18, 0)) div (CAST(left[k - 1] AS decimal(18, 0)) * CAST(right[k - 1] AS decimal(18, 0)))"
    cut = f"named_struct('score', {score}, 'k', k, 'l', left[k - 1], 'r', right[k - 1])"
    return F.expr(f"array_min(transform(sequence(1, size - 1), k -> {cut}))")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
) -> DataFrame:
    """Per language its ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    ``a`` is a phrase's count, ``l`` and ``r`` those of its parts at the cut with the
    lowest score, ``n`` all words of the language. Phrases that a longer one of the same
    count holds are left out. Best first by score, then count, then phrase in byte order.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    counted = scratch.write(counts(stream(docs, text, lang, longest), longest, least), "counts")
    words = counted.where("size = 0").select("lang", F.col("n").alias("n"))
    phrases = parts(counted, scratch, longest)
    phrases = phrases.where("extended IS NULL OR extended < n").withColumnRenamed("n", "a")
    cut = phrases.join(words, "lang").withColumn("cut", _weakest())
    scored = cut.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's phrases are spread over parts, whose best are ranked together.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    inner = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    near = scored.withColumn("part", part).withColumn("place", inner).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    ranked = near.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

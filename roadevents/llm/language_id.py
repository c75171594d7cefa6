"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point. A letter
trigram is the product of its letters' vectors, each rotated by its place. A text is
the sum of its trigrams' vectors, a language the sum over its training texts, and the
prediction is the language whose sum has the largest cosine with the text's.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import no_worker_cache, steps

UNKNOWN = "und"
DIMENSIONS = 1024
SEED = 20_240
# Vectors of trigrams that a worker keeps before it starts afresh.
KEPT_VECTORS = 1 << 14
TEXT = "__text"
# Texts that become vectors in one product.
TEXTS_AT_ONCE = 256


@functools.cache
def _letters() -> np.ndarray:
    """Code point to its lower-case letter, 0 where it is no letter."""
    found = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            found[code] = ord(low) if len(low) == 1 else code
    return found


@functools.cache
def _letter_vector(code: int, dimensions: int) -> np.ndarray:
    bits = np.random.default_rng([SEED, code]).integers(0, 2, dimensions, np.int8)
    return bits * np.int8(2) - np.int8(1)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letter trigrams of all texts, and the text each belongs to.

    A trigram has a letter in its middle; a run of other characters counts as one
    gap, as do the ends of a text.
    """
    joined = "\x00".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[: len(codes)]
    letters = np.concatenate(([0], _letters()[codes], [0]))
    owner = np.concatenate(([0], owner, [0]))
    kept = np.ones(len(letters), bool)
    kept[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    letters, owner = letters[kept], owner[kept]
    if len(letters) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    middle = letters[1:-1] != 0
    found = (letters[:-2] << 42) | (letters[1:-1] << 21) | letters[2:]
    return found[middle], owner[1:-1][middle]


class _Vectors:
    """Trigram vectors, each made when it is first needed."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.rows: dict[int, np.ndarray] = {}

    def _made(self, code: int) -> np.ndarray:
        parts = (code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF)
        a, b, c = (_letter_vector(p, self.dimensions) for p in parts)
        return np.roll(a, 2) * np.roll(b, 1) * c

    def of(self, codes: np.ndarray) -> np.ndarray:
        if len(self.rows) > KEPT_VECTORS:
            self.rows.clear()
        for code in codes.tolist():
            if code not in self.rows:
                self.rows[code] = self._made(code)
        return np.stack([self.rows[code] for code in codes.tolist()])


def _profiles(batches: Iterator[pa.RecordBatch], dimensions: int):
    no_worker_cache()
    vectors, sums = _Vectors(dimensions), {}
    for batch in steps(batches):
        langs = np.array(batch.column("lang").to_pylist(), object)
        codes, owner = trigrams(batch.column("text").to_pylist())
        for lang in dict.fromkeys(langs.tolist()):
            own, counts = np.unique(codes[(langs == lang)[owner]], return_counts=True)
            for at in range(0, len(own), 4096):
                part = vectors.of(own[at : at + 4096]).astype(np.float64)
                found = np.rint(counts[at : at + 4096] @ part).astype(np.int64)
                sums[lang] = sums.get(lang, 0) + found
    for lang, total in sums.items():
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * dimensions, pa.string()),
                "dimension": pa.array(range(dimensions), pa.int32()),
                "total": pa.array(total, pa.int64()),
            }
        )


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    dimensions: int = DIMENSIONS,
) -> dict[str, list[int]]:
    """The profile of every language in ``labelled``: its trigrams' vectors summed.

    Rows without text or language teach nothing. Sums are of whole numbers, so they
    do not depend on the order of rows. The driver receives ``dimensions`` numbers per
    language, never anything per document.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    parts = rows.mapInArrow(
        lambda batches: _profiles(batches, dimensions),
        "lang string, dimension int, total bigint",
    )
    profiles: dict[str, list[int]] = {}
    totals = parts.groupBy("lang", "dimension").agg(F.sum("total").alias("total"))
    for row in totals.collect():
        profiles.setdefault(row["lang"], [0] * dimensions)[row["dimension"]] = row["total"]
    return {name: profiles[name] for name in sorted(profiles) if any(profiles[name])}


def _predictions(batches: Iterator[pa.RecordBatch], profiles, schema: pa.Schema):
    no_worker_cache()
    names = sorted(profiles)
    dimensions = len(profiles[names[0]]) if names else 1
    lines = np.array([profiles[n] for n in names], np.float64).reshape(-1, dimensions)
    lines /= np.linalg.norm(lines, axis=1, keepdims=True)
    vectors = _Vectors(dimensions)
    for batch in steps(batches, TEXT):
        texts = [t or "" for t in batch.column(TEXT).to_pylist()]
        found, scores = [], []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            part = texts[at : at + TEXTS_AT_ONCE]
            codes, owner = trigrams(part)
            own, place = np.unique(codes, return_inverse=True)
            sums = np.zeros((len(part), dimensions))
            for low in range(0, len(own) if names else 0, 4096):
                high = min(low + 4096, len(own))
                inside = (place >= low) & (place < high)
                width = high - low
                cells = owner[inside] * width + (place[inside] - low)
                counts = np.bincount(cells, minlength=len(part) * width)
                counts = counts.reshape(len(part), width).astype(np.float32)
                sums += counts @ vectors.of(own[low:high]).astype(np.float32)
            lettered = np.bincount(owner, minlength=len(part)) > 0
            length = np.linalg.norm(sums, axis=1)
            cosines = sums @ lines.T / np.maximum(length, 1e-300)[:, None]
            for has, row in zip(lettered, cosines, strict=True):
                if not has or not names:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(np.argmax(np.round(row, 12)))
                found.append(names[best])
                scores.append(float(min(1.0, max(0.0, row[best]))))
        columns = batch.columns[: len(schema.names) - 2]
        columns += [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
        yield pa.record_batch(columns, names=schema.names)


def identify(
    docs: DataFrame,
    profiles: dict[str, list[int]],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    pred: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """The columns ``keep`` of every row, its predicted language and the cosine.

    Null text, and text without a letter, is ``und`` with 0. With no profile at all
    every row is. Equal cosines go to the first language by name. Repeated rows stay,
    other columns of any name are left out. A text of any length is read whole, one at
    least at a time. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if {pred, score} & set(keep):
        raise ValueError("kept columns clash with the result's")
    kept = [F.col(f"`{c}`") for c in keep]
    out = docs.select(*kept, F.lit("").alias(pred), F.lit(0.0).alias(score)).schema
    arrow = to_arrow_schema(out)
    rows = docs.select(*kept, F.col(f"`{text}`").alias(TEXT))
    return rows.mapInArrow(lambda b: _predictions(b, profiles, arrow), out)


def is_held_out(key: Column, parts: int = 4, held: int = 2) -> Column:
    """Whether the remainder of the key's checksum sets a document aside."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == held, F.lit(False))


def identify_held_out(docs: DataFrame, text: str = "text") -> DataFrame:
    """Learns from three quarters of the labelled documents and predicts for all.

    Documents without a doc_id are learned from and not held out.
    """
    marked = docs.select("doc_id", "lang", F.col(text).alias("text")).withColumn(
        "held_out", is_held_out(F.col("doc_id"))
    )
    profiles = train(marked.where(~F.col("held_out")))
    return identify(marked, profiles, keep=("doc_id", "held_out"))

"""Content-defined chunks against slow versions, and the edit against plain Python."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadevents.llm import fingerprints as fp


def slow_gear(data, at):
    window = data[max(0, at - 31) : at + 1]
    return sum(int(fp.GEAR[b]) << age for age, b in enumerate(reversed(window))) % 2**32


def slow_cuts(data):
    ends, at = [], 0
    while len(data) - at > fp.SMALLEST:
        last = min(at + fp.LARGEST, len(data))
        for end in range(at + fp.SMALLEST, last):
            mask = fp.HARD if end < at + fp.NORMAL else fp.EASY
            if slow_gear(data, end - 1) & int(mask) == 0:
                last = end
                break
        ends.append(last)
        at = last
    return ends + [len(data)] * (at < len(data))


def text_of(seed, words):
    dice = random.Random(seed)
    return " ".join("".join(dice.choices("abcdeéü", k=dice.randint(1, 9))) for _ in range(words))


@pytest.mark.parametrize("words", [0, 1, 5, 30, 400])
def test_cuts(words):
    data = text_of(words, words).encode()
    assert fp.cuts(data) == slow_cuts(data)
    assert sum(fp.chunks("x" * 5000).values()) <= 5000


def test_insertion_keeps_most_chunks():
    text = text_of(1, 2000)
    moved = text[:500] + "inserted words " + text[500:]
    assert fp.containment(fp.chunks(text), fp.chunks(moved)) > 0.9
    assert fp.containment(fp.chunks(text), fp.chunks(text_of(2, 2000))) < 0.1
    assert fp.decoded(fp.encoded(fp.chunks(text))) == fp.chunks(text)


def expected(rows):
    digest = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42)).view(np.int64)
    ordered = sorted(
        [(i, t or "") for i, t in rows],
        key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), digest(r[1])),
    )
    out = []
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        k = len(text) // 3
        new = text[: len(text) - k] + after[:k]
        own = fp.chunks(text)
        digest = hashlib.sha256(new.encode()).hexdigest()
        likeness = fp.containment(own, fp.chunks(new)), fp.containment(own, fp.chunks(after))
        encodings = fp.encoded(own), fp.encoded(fp.chunks(new))
        out.append((doc, len(text), digest, *encodings, *likeness))
    return sorted(map(repr, out))


@pytest.mark.parametrize("parts", [1, 3, 7, 40])
def test_edit_with_the_next_document(spark, parts):
    rows = [(i * 3 - 20, text_of(i, i * 7 % 50 * 4)) for i in range(30)]
    rows += [(1000, None), (500, ""), (None, "no id"), (4, text_of(3, 9)), (4, text_of(3, 9))]
    rows += [(77, "é" * 100_000)]
    docs = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "doc_id long, text string, part string, id string"
    )
    got = fp.near_after_edit(docs, parts=parts)
    assert got.columns == [c.split()[0] for c in fp.COLUMNS.split(", ")]
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows)
    plain = sorted(map(repr, fp.fingerprints(docs).collect()))
    assert plain == sorted(map(repr, got.select("doc_id", "fingerprint").collect()))


def test_one_and_no_document(spark):
    docs = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    (row,) = fp.near_after_edit(docs).collect()
    assert row["near_next"] == 1.0 and row["n_chars"] == 7
    assert fp.near_after_edit(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [2, 8, 30])
def test_many_rows_of_one_id_are_spread(spark, parts):
    rows = [(None, text_of(i, 3)) for i in range(120)] + [(7, text_of(i, 2)) for i in range(90)]
    rows += [(i, text_of(i, 4)) for i in range(60)] + [(None, "same")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = fp.with_next(docs, parts=parts).where("NOT extra")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 0.7 * parts
    assert max(sizes) < 3 * len(rows) / parts + 10
    got = fp.near_after_edit(docs, parts=parts).collect()
    assert sorted(repr(tuple(r)) for r in got) == expected(rows)


def test_kept_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, fingerprint string")
    with pytest.raises(ValueError, match="clash"):
        fp.fingerprints(docs, keep=("doc_id", "fingerprint"))

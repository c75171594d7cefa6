"""Repeated strings against a dictionary of every string of every document."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import DATA
from roadevents.llm import bitmaps
from roadevents.llm import suffixes as sx
from roadevents.llm.common import Scratch


def slow(rows):
    """doc_id, n_bytes, n_removed, n_spans, digest by looking at all strings in order."""
    ordered = sorted({(d if d is not None else -(2**63), h, (t or "").encode()) for d, t, h in rows})
    seen, result = set(), {}
    for doc, h, data in ordered:
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - sx.LENGTH + 1):
            own = data[at : at + sx.LENGTH]
            if own in seen:
                gone[at : at + sx.LENGTH] = True
            seen.add(own)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        starts = (np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()
        result[doc, h] = (len(data), int(gone.sum()), int(starts), hashlib.sha256(kept).hexdigest())
    return sorted(repr((d, *result[d if d is not None else -(2**63), h])) for d, _, h in rows)


def cases():
    dice = random.Random(6)
    word = lambda: "".join(dice.choices("abcdé", k=dice.randint(1, 5)))
    base = [" ".join(word() for _ in range(dice.randint(5, 160))) for _ in range(12)]
    rows = []
    for d in range(70):
        kind, own = dice.randint(0, 5), list(dice.choice(base))
        if kind < 3:
            for _ in range(dice.randint(0, 4)):
                own[dice.randrange(len(own))] = dice.choice("xyz")
        if kind == 3:
            own = own[dice.randrange(len(own)) :]
        if kind == 4:
            own = [*dice.choice(base)[: dice.randint(50, 300)], *own]
        if kind == 5:
            own = list("ab, cd. " * dice.randint(1, 80) + word() * 30)
        rows.append((d, "".join(own)))
    rows += [(100, "a" * 700), (101, "a" * 99), (102, "a" * 100), (103, None), (104, "")]
    rows += [(5, base[0]), (5, base[0]), (5, base[1]), (None, base[2]), (-4, base[2])]
    return rows


def test_every_string(spark):
    rows = cases()
    docs = spark.createDataFrame(
        [(*r, 1, "k") for r in rows], "doc_id long, text string, start int, kept string"
    )
    hashes = [r["doc_hash"] for r in sx.keyed(docs).collect()]
    got = sx.dedup_report(docs)
    expected = slow([(*r, h) for r, h in zip(rows, hashes)])
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected
    assert sx.dedup_report(docs.limit(0)).count() == 0


def test_small_steps_and_maps(spark, monkeypatch):
    rows = cases()[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = [r["doc_hash"] for r in sx.keyed(docs).collect()]
    monkeypatch.setattr(sx, "STARTS", 37)
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    keys, places, first, last = sx.anchors(data)
    assert first[0] == 0 and last[-1] == len(data) - sx.LENGTH
    assert (first[1:] == last[:-1] + 1).all()
    assert ((places >= last) & (places <= first + sx.LENGTH - sx.Q)).all()
    got = sorted(repr(tuple(r)) for r in sx.dedup_report(docs).collect())
    assert got == slow([(*r, h) for r, h in zip(rows, hashes)])


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{DATA}/{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"], 0) for r in docs.collect()]
    got = sorted(repr(tuple(r)) for r in sx.dedup_report(docs).collect())
    assert got == slow(rows)


def test_a_megabyte_of_one_byte(spark):
    rows = [(1, "a" * 1_000_000), (2, "ab" * 20_000), (3, "x" + "a" * 5000), (4, "b" * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = [r["doc_hash"] for r in sx.keyed(docs).collect()]
    got = sorted(repr(tuple(r)) for r in sx.dedup_report(docs).collect())
    assert got == slow([(*r, h) for r, h in zip(rows, hashes)])


def test_short_texts_are_looked_at_together(monkeypatch):
    texts = [(t or "").encode() for _, t in cases()]
    docs = [pa.array(range(len(texts))), pa.array([7] * len(texts)), pa.array(texts).cast(pa.string())]
    batch = pa.RecordBatch.from_arrays(docs, names=["doc_id", "doc_hash", "text"])
    looked, identifiers = [], sx.identifiers
    monkeypatch.setattr(sx, "identifiers", lambda *a: looked.append(1) or identifiers(*a))
    alone = [sx.anchors(np.frombuffer(t, np.uint8)) for t in texts]
    expected = np.concatenate([keys.view(np.int64) for keys, *_ in alone])
    looked.clear()
    got = np.concatenate([b.column(0).to_numpy() for b in sx._keys(iter([batch.slice(0, 9), batch.slice(9)]))])
    assert (got == expected).all()
    assert len(looked) <= 2 + sum(map(len, texts)) // sx.GROUP
    # Places count from the start of all texts.
    ends = np.cumsum([len(t) for t in texts])
    _, places, first, last = sx.anchors(np.frombuffer(b"".join(texts), np.uint8), ends=ends)
    shift = np.repeat(ends - [len(t) for t in texts], [len(a[0]) for a in alone])
    for together, n in ((places, 1), (first, 2), (last, 3)):
        assert (together == np.concatenate([a[n] for a in alone]) + shift).all()


def test_a_repeated_run_reaches_one_task_once_a_chunk():
    ids = [np.array([5, 5, 5, 6, 5, 5]), np.array([1, 1, 1, 1, 2, 1])]
    at = [np.array([3, 2, 2, 2, 2, 9]), np.zeros(6, np.int64), np.array([0, 8, 8, 0, 4, 1])]
    keep, lots = sx._lots(ids, at)
    # The earliest of (5, 1) is at document 2, place 8, in two equal rows.
    assert keep.tolist() in ([True, True, False, True, True, True], [True, False, True, True, True, True])
    assert (lots != 0)[keep].tolist() == [True, False, False, False, True]
    assert len(set(lots[[0, 5]])) == 2
    assert [x.tolist() for x in sx._lots([np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int64)] * 3)] == [[], []]


def test_maps_grow_with_their_keys(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "BITS", 16)
    own, others = np.arange(60_000), np.arange(60_000, 300_000)
    scratch = Scratch(spark, "maps")
    found = bitmaps.BitMap.sized(spark.range(60_000), 60_000, scratch)
    assert found.has(own).all()
    assert found.has(others).mean() < 0.01
    monkeypatch.setattr(bitmaps, "MOST_BITS", 12)
    found = bitmaps.BitMap.sized(spark.range(60_000), 60_000, scratch)
    assert len(found.held) == 512 and found.has(own).all()


@pytest.mark.parametrize("most", [30, 6])
def test_contexts_are_those_of_open_anchors(spark, monkeypatch, most):
    monkeypatch.setattr(bitmaps, "BITS", 6)
    monkeypatch.setattr(bitmaps, "MOST_BITS", most)
    dice = random.Random(9)
    noise = lambda n: "".join(dice.choices("abcdefgh ", k=n))
    shared = [noise(130) for _ in range(6)]
    rows = [(d, noise(1500) + (shared[d % 6] if d % 2 else "") + noise(1500)) for d in range(60)]
    counts, write = {}, Scratch.write

    def counted(self, df, name, *rest):
        found = write(self, df, name, *rest)
        counts[name] = found.count()
        return found

    monkeypatch.setattr(Scratch, "write", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = [r["doc_hash"] for r in sx.keyed(docs).collect()]
    got = sorted(repr(tuple(r)) for r in sx.dedup_report(docs).collect())
    # Full maps cost work, not results.
    assert got == slow([(*r, h) for r, h in zip(rows, hashes)])
    assert counts["open-anchor"] > 0
    if most == 30:
        assert counts["contexts"] <= counts["open-anchor"] * 1.2

"""Greedy string tiling against a plain version over words, and planted passages."""

import random

import pytest

from conftest import DATA
from roadevents.llm import decontaminate as dc


def slow_tiles(item, doc, shortest):
    """The published loop: all longest matches of unmarked words, marked, until short."""
    used_i, used_j, tiles = set(), set(), []
    while True:
        best, found = shortest - 1, []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                    and i + n not in used_i and j + n not in used_j
                ):
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best and n >= shortest:
                    found.append((i, j))
        if not found:
            return tiles
        for i, j in found:
            own_i, own_j = set(range(i, i + best)), set(range(j, j + best))
            if not (own_i & used_i or own_j & used_j):
                tiles.append((i, j, best))
                used_i |= own_i
                used_j |= own_j


@pytest.mark.parametrize("seed", range(60))
def test_tiling(seed):
    dice = random.Random(seed)
    item = dice.choices(range(4), k=dice.randint(3, 14))
    doc = dice.choices(range(4), k=dice.randint(3, 25))
    pairs = [
        (i, j)
        for i in range(len(item) - 2)
        for j in range(len(doc) - 2)
        if item[i : i + 3] == doc[j : j + 3]
    ]
    assert dc.tile(item, doc, pairs, 3) == slow_tiles(item, doc, 3)


def cases():
    dice = random.Random(5)
    words = ["".join(dice.choices("abcdefgh", k=4)) for _ in range(400)]
    items = [(i, " ".join(dice.choices(words, k=30))) for i in range(12)]
    items += [(50, items[0][1]), (51, None), (52, ""), (53, "two words"), (None, items[1][1])]
    docs = []
    for d in range(80):
        text = dice.choices(words, k=dice.randint(0, 120))
        if d % 3 == 0:
            own = dice.choice(items[:12])[1].upper().split()
            parts = [own[i : i + 6] for i in range(0, 30, 6)]
            dice.shuffle(parts)
            for part in parts[: dice.randint(1, 5)]:
                at = dice.randint(0, len(text))
                text[at:at] = part
        docs.append((d, " ".join(text)))
    docs += [(7, docs[0][1]), (None, items[3][1]), (900, None), (901, ""), (902, "x " * 40_000)]
    return docs, items


def expected(docs, items):
    for doc, text in docs:
        for item, own in items:
            a, b = (own or "").lower().split(), (text or "").lower().split()
            tiles = slow_tiles(a, b, 4) if len(b) < 10_000 else []
            covered = sum(t[2] for t in tiles)
            if tiles and covered >= 0.5 * len(a):
                yield doc, item, len(a), covered, tiles[0][2], len(tiles), covered / len(a)


@pytest.mark.parametrize("block_words", [40, 1 << 20])
def test_all_pairs(spark, block_words):
    docs, items = cases()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id long")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long")
    got = dc.contaminated(d, b, block_words=block_words)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected(docs, items)))
    hit = {(r[0], r[1]) for r in docs for x in expected([r], items)}
    kept = dc.uncontaminated(d, b, block_words=block_words)
    assert kept.columns == d.columns
    left = sorted(repr(tuple(r)[:2]) for r in kept.collect())
    assert left == sorted(repr(r) for r in docs if r not in hit)
    assert dc.uncontaminated(d, b.limit(0)).count() == len(docs)
    assert dc.contaminated(d, b.limit(0)).count() == 0
    assert dc.contaminated(d.limit(0), b).count() == 0
    with pytest.raises(ValueError, match="clash"):
        dc.contaminated(d, b, keep=("doc_id", "item_id"))


def test_planted_and_clean(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    items = spark.read.parquet(f"{DATA}/sf0.01/benchmark.parquet")
    flat = lambda t: f" {' '.join(t.lower().split())} "
    known = [(r["item_id"], flat(r["text"])) for r in items.collect()]
    whole = {
        (r["doc_id"], i) for r in docs.collect() for i, t in known if t in flat(r["text"])
    }
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in dc.contaminated(docs, items).collect()}
    assert whole and whole <= set(got)
    assert all(got[p] == 1.0 for p in whole)


def test_a_sentence_that_all_items_share_makes_no_pairs(monkeypatch):
    common = "answer the question below in one word please".split()
    items = dc._Items([(i, " ".join([*common, *(f"i{i}w{k}" for k in range(12))])) for i in range(4000)], 4)
    asked = []
    monkeypatch.setattr(dc, "tile", lambda item, doc, pairs, shortest: asked.append(len(pairs)) or [])
    words = dc.word_ids([" ".join([*common * 60, *(f"i7w{k}" for k in range(12))])])[0]
    assert list(dc._covering(words, items, 4, 0.5)) == []
    # Only the item whose other words are there, too, is tiled.
    assert len(asked) == 1 and asked[0] < 1000

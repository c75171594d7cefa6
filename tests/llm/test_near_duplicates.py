"""Near duplicates against all pairs of shingle sets, and components against union-find."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from roadevents.llm import near_duplicates as nd
from roadevents.llm.common import Scratch
from roadevents.llm.components import components


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def slow(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    of, least = roots(len(rows), links), {}
    for (doc, _), r, own in zip(rows, of, sets):
        if doc is not None and own:
            least[r] = min(doc, least.get(r, doc))
    out = [
        (doc, len(own), least.get(r, doc) if own else doc) for (doc, _), r, own in zip(rows, of, sets)
    ]
    return sorted(map(repr, out))


def cases(seed, docs=150, common=0):
    dice = random.Random(seed)
    vocab = ["".join(dice.choices("abcdé", k=4)) for _ in range(600)]
    base = [dice.choices(vocab, k=dice.choice([3, 5, 8, 40, 90, 200])) for _ in range(25)]
    passage = dice.choices(vocab, k=60)
    rows = []
    for d in range(docs):
        own = list(dice.choice(base))
        for _ in range(dice.choice([0, 0, 1, 1, 2, 3, 6])):
            own[dice.randrange(len(own))] = dice.choice(vocab)
        if d < common:
            own = passage + own[: dice.randint(1, 30)]
        rows.append((d, dice.choice([" ", "\n", " \t"]).join(own).title()))
    rows += [(500, None), (501, ""), (502, " \n"), (None, rows[0][1]), (None, "only here once")]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (3, "other text of the same id"), (600, "w " * 9000)]
    return rows


@pytest.mark.parametrize("seed, common, block", [(1, 0, 1000), (2, 90, 1000), (3, 120, 12)])
def test_all_pairs(spark, monkeypatch, seed, common, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "LEAF", 4)
    rows = cases(seed, common=common)
    docs = spark.createDataFrame([(*r, b"x", 1) for r in rows], "doc_id long, text string, cls binary, n int")
    got = nd.near_duplicates(docs)
    assert sorted(repr(tuple(r)) for r in got.collect()) == slow(rows)


def test_a_pair_of_many_groups_is_made_once(spark, monkeypatch):
    rows, made, search = cases(2, common=90), spark.sparkContext.accumulator(0), nd._search
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "t")
    info = scratch.write(docs.withColumn("text_id", F.lit(b"x")).mapInArrow(nd._info, nd.INFO), "info")
    firsts = nd._Firsts(info)
    own = docs.mapInArrow(lambda b: nd._own(b, firsts), nd.OWN)
    own = scratch.write(own.withColumn("id", F.monotonically_increasing_id()), "own")

    def counted(batches):
        for batch in search(batches):
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(nd, "_search", counted)
    none = spark.createDataFrame([], "cls binary, comp binary")
    found = scratch.write(nd._searched(nd._members(own, scratch), none, scratch), "found").count()
    assert 0 < made.value < 2 * found


def test_groups_of_the_same_classes_are_one(spark):
    groups = {5: [1, 2, 3], 3: [1, 2, 3], 9: [1, 2], 7: [4]}
    rows = [(i, token) for token, ids in groups.items() for i in ids]
    got = nd._distinct_groups(spark.createDataFrame(rows, "id long, token long"))
    assert sorted(map(tuple, got.collect())) == [(1, 3), (1, 9), (2, 3), (2, 9), (3, 3)]


def test_no_rows(spark):
    assert nd.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_finds_what_all_pairs_do():
    dice = np.random.default_rng(3)
    base = [np.unique(dice.integers(0, 2**63, 60, np.uint64)) for _ in range(5)]
    sets = []
    for _ in range(140):
        own = base[dice.integers(5)].copy()
        own[dice.integers(0, len(own), dice.integers(0, 12))] = dice.integers(0, 2**63, 1, np.uint64)
        sets.append(np.unique(own[: dice.integers(30, 61)]))
    bits = np.stack([nd.signature(s) for s in sets]).view(np.uint64)
    sizes, comps = np.array([len(s) for s in sets]), dice.integers(0, 90, 140)
    true = {
        (i, j)
        for i in range(140)
        for j in range(i + 1, 140)
        if comps[i] != comps[j]
        and nd.linked(len(np.intersect1d(sets[i], sets[j])), sizes[i], sizes[j])
    }
    every = np.arange(140)
    got = [tuple(sorted(p)) for p in nd.tree_pairs(bits, sizes, comps, every, every)]
    assert true and true <= set(got) and len(got) == len(set(got))
    assert len(got) < 140 * 139 / 4
    halves = [tuple(sorted(p)) for p in nd.tree_pairs(bits, sizes, comps, every[:70], every[70:])]
    assert set(halves) == {p for p in got if p[0] < 70 <= p[1]}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    dice = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(30, i) for i in range(60) if i != 30],
        "random": [(dice.randrange(80), dice.randrange(80)) for _ in range(50)],
        "none": [],
    }[kind]
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r["cls"]: r["comp"] for r in components(links, Scratch(spark, "t"), "c").collect()}
    of = roots(81, edges)
    seen = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: min(y for y in seen if of[y] == of[x]) for x in seen}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(repr(tuple(r)) for r in nd.near_duplicates(docs).collect())
    assert got == slow(rows)

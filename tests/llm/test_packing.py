"""Packing: ids against the tokenizer, gapless sequences, bounds against brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import DATA
from roadevents.llm import common
from roadevents.llm import packing as pk
from roadevents.llm.tokens import encoder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_equal_the_tokenizers(tokenizer, spark):
    dice = random.Random(1)
    odd = "ab Éé́̀  \t\n\r\x1c\x85' 'sS'LLßΣς ½①²٣7<|endoftext|>İ​漢字🙂\x00"
    texts = ["".join(dice.choices(odd, k=dice.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(dice.choices("abzßéüÿàö×÷ÉÜA.,", k=dice.randint(1, 12))) for _ in range(4000)]
    texts += ["<|endoftext|> a<|startoftext|>", "<|ENDOFTEXT|>", "<|end oftext|>", "A  b", "don't 'll x'Re"]
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    texts += [r["text"] for r in docs.select("text").collect()]
    found = encoder().ids(texts)
    for text, own in zip(texts, found):
        assert own.tolist() == ids(tokenizer, text)[:-1], text


def optimum(lengths, capacity):
    """The fewest bins by trying every assignment."""
    for n in range(1, len(lengths) + 1):
        for places in itertools.product(range(n), repeat=len(lengths)):
            sums = np.bincount(places, weights=lengths, minlength=n)
            if sums.max() <= capacity:
                return n
    return 0


def test_bound_and_best_fit():
    dice = random.Random(2)
    for _ in range(150):
        lengths = np.array([dice.randint(1, 12) for _ in range(dice.randint(1, 6))])
        bins, offsets = pk.best_fit(lengths, 12)
        best = optimum(lengths, 12)
        assert pk.lower_bound(lengths, 12) <= best <= bins.max() + 1
        for b in set(bins):
            own = sorted(zip(offsets[bins == b], lengths[bins == b]))
            assert own[0][0] == 0
            assert all(o + n == p for (o, n), (p, _) in zip(own, own[1:]))
            assert sum(own[-1]) <= 12
    assert pk.lower_bound(np.array([7, 7, 7]), 12) == 3


ROWS = [(1, "some words here"), (1, "some words here"), (2, None), (None, ""), (3, "word " * 5000)]


def check(rows, got, tokenizer, capacity):
    expected = []
    for doc, text in rows:
        own = np.array(ids(tokenizer, text), "<u4")
        for start in range(0, len(own), capacity):
            part = own[start : start + capacity]
            expected.append((doc, start // capacity, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:5]) for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and sum(own[-1]) <= capacity
        assert all(o + n == p for (o, n), (p, _) in zip(own, own[1:]))
    lengths = np.array([r["length"] for r in got])
    return len(sequences), pk.lower_bound(lengths, capacity)


def test_small_rows(spark, tokenizer):
    docs = spark.createDataFrame(
        [(*r, 1, "x") for r in ROWS], "doc_id long, text string, item int, offset string"
    )
    n, bound = check(ROWS, pk.pack_documents(docs).collect(), tokenizer, 2048)
    assert n == bound
    assert pk.pack_documents(docs.limit(0)).count() == 0


def test_groups_exchange(spark, tokenizer):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = pk.pack_documents(docs, group=250).collect()
    n, bound = check(rows, got, tokenizer, 2048)
    assert n <= bound + 1


def test_loose_bounds_still_end(spark):
    items = spark.range(900).selectExpr("id AS item", "CAST(700 + id % 7 AS BIGINT) AS length")
    got = pk.pack(items, group=20).collect()
    assert len(got) == 900
    sums = {}
    for r in got:
        sums[r["sequence_id"]] = sums.get(r["sequence_id"], 0) + 1
    assert max(sums.values()) == 2


def test_a_worker_holds_one_cache_at_a_time():
    made = []
    make = lambda: made.append(1) or {}
    first = common.worker_cache("a", make)
    first["word"] = 1
    assert common.worker_cache("a", make) is first
    assert common.worker_cache("b", make) == {} and common.worker_cache("a", make) == {}
    assert len(made) == 3

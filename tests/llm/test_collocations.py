"""Collocations against counting every phrase in a dictionary."""

import random
import re
from collections import Counter

import pytest

from roadevents.llm import collocations
from roadevents.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def phrases(docs, longest=5):
    counts, totals = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, totals


def plain(docs, least, top, longest=5):
    counts, totals = phrases(docs, longest)
    frequent = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    held = {}
    for (lang, w), a in frequent.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    held[lang, w[i:j]] = max(a, held.get((lang, w[i:j]), 0))
    rows = []
    for (lang, w), a in frequent.items():
        if held.get((lang, w), 0) >= a:
            continue
        n = totals[lang]
        cuts = [(counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        rows.append((lang, " ".join(w), a, l, r, n, score))
    rows.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    out, rank = [], Counter()
    for lang, *rest in rows:
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], *rest))
    return out


def mined(spark, docs, parts=3, **options):
    df = spark.createDataFrame(docs, SCHEMA).repartition(parts)
    found = collocations.collocations(df, **options)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def corpus(rng, n, words, gaps=(" ", "  ", "\t", ". ", "\n", ",", "\x0b")):
    docs = []
    for i in range(n):
        size = rng.choice([0, 1, 2, 5, 30, 80])
        text = "".join(rng.choice(words) + rng.choices(gaps, [30] + [1] * (len(gaps) - 1))[0] for _ in range(size))
        docs.append((i, rng.choice([text, text, text, None, text.upper()]), rng.choice(["en", "de", None, "und"])))
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_equals_counting(spark, seed):
    rng = random.Random(seed)
    words = ["the", "of", "a", "ab", "a\x01", "\x00", "ß", "日本", "and", "x-y", "'s", "\x1f", "a" * 50]
    docs = corpus(rng, 120, words[: 4 + 4 * seed])
    expected = plain(docs, 8, 40)
    assert len(expected) > 40
    assert mined(spark, docs, least=8, top=40) == sorted(expected)


def test_stretches_and_ranges_do_not_matter(spark, monkeypatch):
    rng = random.Random(9)
    docs = corpus(rng, 40, ["one", "two", "three", "four"])
    docs.append((99, " ".join(rng.choice(["one", "two", "five"]) for _ in range(3000)), "en"))
    docs.append((98, "one two three four five " * 300, "en"))
    expected = sorted(plain(docs, 20, 100))
    assert mined(spark, docs, least=20, top=100) == expected
    # Tasks are forked from this process, so small stretches must be set where they run.
    data = docs[-2][1].encode()
    for size in (1, 7, 100):
        monkeypatch.setattr(collocations, "STRETCH", size)
        found = Counter()
        for part, own in collocations._stretches(data, 5):
            words, counts = collocations._combined(part, own, 5) or ([], [])
            assert [w.as_py() for w in words] == sorted(w.as_py() for w in words)
            for w, c in zip(words, counts):
                found[w.as_py().decode()] += int(c)
        split = data.decode().split()
        assert found == Counter("".join(w + " " for w in split[i : i + 5]) for i in range(len(split)))


def test_runs_over_batches_and_parts(monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    docs = corpus(rng, 60, ["a", "b", "c"])
    windows = Counter()
    counts, totals = phrases(docs)
    for _, text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                windows["und" if lang is None else lang, "".join(w + " " for w in words[i : i + 5])] += 1
    rows = sorted((lang, w, n) for (lang, w), n in windows.items())
    monkeypatch.setattr(collocations, "ROWS", 7)
    for cut in (0, 1, 13, len(rows) // 2):
        found = Counter()
        for part in (rows[:cut], rows[cut:]):
            batches = [
                pa.record_batch([pa.array(c) for c in zip(*part[i : i + 3])], names=["lang", "words", "n"])
                for i in range(0, len(part), 3)
            ]
            for batch in collocations._runs(batches, 5, 15):
                for r in batch.to_pylist():
                    found[r["lang"], r["size"], r["phrase"]] += r["n"]
        for (lang, w), n in counts.items():
            if n >= 15:
                assert found[lang, len(w), " ".join(w)] == n
        assert {k[0]: n for k, n in found.items() if k[1] == 0} == dict(totals)


def test_ranges_keep_the_order():
    import pyarrow as pa

    words = sorted(["a ", "a\x01 ", "a b ", "b ", "c c ", "ß "], key=lambda w: w.encode())
    array = pa.array([w.encode() for w in words])
    rows = [(lang, w.encode()) for lang in (b"de", b"en", b"en\x00", b"fr") for w in words]
    for bounds in ([], [(b"en", b"b")], sorted([rows[3], rows[9], rows[10], (b"en", b"a\x01"), (b"x", b"")])):
        for lang in (b"de", b"en", b"en\x00", b"fr"):
            parts = collocations._range_of(bounds, lang, array)
            assert parts.tolist() == [sum(b <= (lang, w.encode()) for b in bounds) for w in words]


def test_exact_beyond_64_bits(spark):
    rows = [("en", 1, "x", 3 * 10**9), ("en", 1, "y", 3 * 10**9 + 1), ("en", 2, "x y", 3 * 10**9 - 1)]
    counted = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    found = collocations.parts(counted, Scratch(spark, "test"), 2).withColumnRenamed("n", "a")
    n = 10**13 + 7
    cut = found.selectExpr("*", f"{n}L AS n").select(collocations._weakest().alias("cut")).first().cut
    assert cut.score == 1000 * (3 * 10**9 - 1) * n // (3 * 10**9 * (3 * 10**9 + 1))


def test_one_hot_phrase_and_odd_tables(spark):
    docs = [(i, "again again again again again again again", "en") for i in range(50)]
    assert mined(spark, docs, least=10) == sorted(plain(docs, 10, 2000))
    assert mined(spark, [(1, None, None), (2, "", "en"), (3, "a b", "en")]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).collect() == []


def test_a_very_long_text_and_clashing_columns(spark):
    rng = random.Random(7)
    text = " ".join(rng.choice(["red", "green", "blue"]) for _ in range(1_500_000))  # some stretches
    docs = spark.createDataFrame([(1, text + " " + "w" * 4_000_000, "en")], SCHEMA)
    clashing = docs.selectExpr("*", "1 AS n", "2 AS words", "'z' AS phrase", "3 AS size")
    got = [tuple(r) for r in collocations.collocations(clashing, longest=2).collect()]
    assert sorted(got) == sorted(plain([(1, text + " w", "en")], 100, 2000, longest=2))
    with pytest.raises(ValueError, match="2 to 6"):
        collocations.windows(docs, longest=7)

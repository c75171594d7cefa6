"""Hyperdimensional profiles against a per-letter computation and on held-out text."""

import numpy as np
import pytest

from conftest import DATA
from roadevents.llm import common
from roadevents.llm import language_id as li


def slow_vector(text, dimensions):
    symbols, total = [0], np.zeros(dimensions, np.int64)
    for char in text:
        code = ord(char.lower()) if char.isalpha() else 0
        if code or symbols[-1]:
            symbols.append(code)
    if symbols[-1]:
        symbols.append(0)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        if b:
            v = [li._letter_vector(x, dimensions).astype(np.int64) for x in (a, b, c)]
            total += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return total


ROWS = [
    (1, "the cat, the dog", "en"),
    (2, "der Hund -- die Katze", "de"),
    (3, "über das Haus", "de"),
    (4, "the house and the cat", "en"),
    (4, "the house and the cat", "en"),
    (5, None, "en"),
    (6, "", None),
    (7, "12 34 !?", "de"),
    (8, "x", None),
    (None, "the dog " * 3000, None),
]


def test_same_as_letter_by_letter(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    profiles = li.train(docs, dimensions=64)
    expected = {}
    for _, text, lang in ROWS:
        if text and lang:
            expected[lang] = expected.get(lang, 0) + slow_vector(text, 64)
    assert {k: v.tolist() for k, v in expected.items()} == profiles
    got = li.identify(docs, profiles).collect()
    assert len(got) == len(ROWS)
    texts = {r[0]: r[1] for r in ROWS}
    for row in got:
        vector = slow_vector(texts[row["doc_id"]] or "", 64)
        if not vector.any():
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        cosines = {
            k: vector @ v / np.linalg.norm(vector) / np.linalg.norm(v)
            for k, v in expected.items()
        }
        best = max(cosines, key=cosines.get)
        assert row["lang_pred"] == best
        assert row["score"] == pytest.approx(max(0, cosines[best]))


def test_nothing_learned_and_no_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in li.identify(docs, {}).collect()} == {"und"}
    assert li.identify_held_out(docs.limit(0)).count() == 0


def test_extra_columns_and_clashing_names(spark):
    docs = spark.createDataFrame(
        [(1, "the cat", "en", "z", 0.5)],
        "doc_id long, text string, lang string, lang_pred string, score double",
    )
    got = li.identify_held_out(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert got.count() == 1
    with pytest.raises(ValueError, match="clash"):
        li.identify(docs, {}, keep=("score",))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    got = li.identify_held_out(docs).where("held_out")
    joined = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(joined) > 150
    right = sum(r["lang"] == r["lang_pred"] for r in joined)
    assert right >= 0.97 * len(joined)


def test_what_other_operators_kept_goes():
    common.worker_cache("words of another operator", list)
    assert list(li._predictions(iter([]), {}, None)) == []
    assert "words of another operator" not in common._held

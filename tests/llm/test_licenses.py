"""The license join against a loop over all lines and templates."""

import math
import random
import re

import pytest

from roadevents.llm import licenses as li

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def slow_matches(text, templates, threshold):
    for block, line in enumerate(low(text).split("\n")):
        own = set(WORD.findall(line))
        for number, (label, words) in enumerate(templates):
            tokens = set(words.split())
            if len(own & tokens) >= math.ceil(threshold * len(tokens) - 1e-9):
                yield block, number, label, len(own & tokens) / len(tokens)


def slow_row(doc, text):
    words = WORD.findall(low(text))
    base = []
    for label, phrase in li.PHRASES.items():
        parts = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    found = list(slow_matches(text, li.TEMPLATES, li.THRESHOLD))
    labels = {x[1] for x in base}
    starts = [x[0] for x in base]
    score = 1.0 if base else max((f[3] for f in found), default=0.0)
    joined = ",".join(sorted(labels | {f[2] for f in found}))
    return (
        doc, len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)), joined, score,
    )


ROWS = [
    (1, "Released under the MIT License."),
    (1, "Released under the MIT License."),
    (2, "the GNU General Public\nLicense, MIT license mit LICENSE"),
    (3, None),
    (4, ""),
    (5, "Licensed under CC BY-NC 4.0.\nplain éÉ text"),
    (6, "under licensed by cc nc 4"),
    (None, "This work is licensed under the GNU General Public License, version 3."),
    (None, None),
    (7, "mit license " * 20_000),
    (8, "Apache\x00License apacheé license"),
    (9, "..., ---\n\n"),
]


def test_rows(spark):
    docs = spark.createDataFrame(
        [(*r, "z", "q") for r in ROWS], "doc_id long, text string, labels string, token string"
    )
    got = [tuple(r) for r in li.scan(docs).collect()]
    assert sorted(map(repr, got)) == sorted(repr(slow_row(*r)) for r in ROWS)
    assert li.scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 1.0])
def test_every_match_is_found(spark, threshold):
    dice = random.Random(int(threshold * 10))
    words = "a b c d e f g h".split()
    templates = [
        (f"t{i}", " ".join(dice.choices(words, k=dice.randint(1, 7)))) for i in range(8)
    ]
    texts = [
        "\n".join(" ".join(dice.choices(words + ["x", "y"], k=dice.randint(0, 9))) for _ in range(3))
        for _ in range(60)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = li.matches(docs, templates, threshold).collect()
    expected = [
        (doc, *match) for doc, t in enumerate(texts) for match in slow_matches(t, templates, threshold)
    ]
    assert sorted(tuple(r) for r in got) == sorted(expected)


BSD = (
    "Copyright 2020 The Authors. All rights reserved.\n\n"
    "Redistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions\nare met:"
)
GPL = (
    "/*\n * This program is free software: you can redistribute it and/or modify\n"
    " * it under the terms of the GNU General Public License as published by\n"
    " * the Free Software Foundation."
)
NARROW = "redistribution and\n\nuse in\nsource\n--\nand binary\nforms with\nor without modification\nare permitted"
FAR = "redistribution and use in source and binary forms" + " x" * 30 + "\nwith or without modification"


def test_wrapped_notices(spark):
    texts = [BSD, GPL, NARROW, FAR, BSD.replace("\n", " "), "a\nb", "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in li.scan(docs).collect()}
    assert got == {
        0: ("bsd", 1.0), 1: ("gpl", 1.0), 2: ("bsd", 1.0), 3: ("", 0.0), 4: ("bsd", 1.0),
        5: ("", 0.0), 6: ("", 0.0),
    }
    found = li.block_matches(docs.where("doc_id = 1")).collect()
    assert ("gpl", 1.0) in {(r["label"], r["share"]) for r in found}


@pytest.mark.parametrize("threshold", [0.6, 1.0])
def test_every_match_across_lines_is_found(spark, threshold):
    dice = random.Random(int(threshold * 10))
    words = "a b c d e f g h".split()
    templates = [
        (f"t{i}", " ".join(dice.choices(words, k=dice.randint(1, 7)))) for i in range(8)
    ]
    texts = [
        "\n".join(" ".join(dice.choices(words + ["x"], k=dice.randint(0, 4))) for _ in range(6))
        for _ in range(60)
    ]

    def slow(doc, text):
        for _, number, label, share in slow_matches(text, templates, threshold):
            yield doc, number, label, share
        lines = [w for line in text.split("\n") if (w := WORD.findall(line))]
        for i in range(1, len(lines)):
            for number, (label, t) in enumerate(templates):
                n, tokens = len(t.split()) - 1, set(t.split())
                own = set(lines[i - 1][max(len(lines[i - 1]) - n, 0) :] + sum(lines[i:], [])[:n])
                if len(own & tokens) >= math.ceil(threshold * len(tokens) - 1e-9):
                    yield doc, number, label, len(own & tokens) / len(tokens)

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = li.block_matches(docs, templates, threshold).drop("block").collect()
    expected = [row for doc, t in enumerate(texts) for row in slow(doc, t)]
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_kept_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "mit license", 2, 3)], "doc_id long, text string, lines int, other int")
    for scan in (li.matches, li.block_matches):
        assert scan(docs, keep=("doc_id", "other")).columns[:2] == ["doc_id", "other"]
        with pytest.raises(ValueError, match="lines"):
            scan(docs, keep=("doc_id", "lines"))

"""License scan: an exact containment join of text blocks with license notices.

A block is a line, or, for a notice wrapped over lines, the words on both sides of a
line's end; its tokens are the distinct words. It matches a template when it has at
least ``threshold`` of the template's tokens. Tokens have one global order, the rarest
in the corpus first. A block that misses all of a template's rarest tokens (its prefix)
cannot match, one with too few tokens cannot, and one whose shared token stands so late
that too few can follow cannot either; what is left is counted in full.

A text of any length is read whole, as one row of its task; its lines are rows of their
own. An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import lower_ascii

THRESHOLD = 0.8
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OWN_NAMES = {
    "text", "line", "lines", "heads", "words", "before", "after", "block", "own", "place",
    "token", "tokens", "at", "n", "need", "template", "label", "share",
}

# The phrases of the base labels.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}

# Notices by label, as commonly written.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def words(text: Column) -> Column:
    """The words of lower-cased ``text`` in order."""
    return F.filter(F.split(text, NOT_WORDS), lambda w: w != "")


def _templates(templates, threshold: float) -> list[tuple[str, list[str], int]]:
    """Label, distinct tokens and how many of them a block must have."""
    found = []
    for label, text in templates:
        tokens = list(dict.fromkeys(text.split()))
        if tokens:
            found.append((label, tokens, max(1, math.ceil(threshold * len(tokens) - 1e-9))))
    return found


def places(tokens: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """Where the phrases' words stand one after another: structs of start and label."""
    def of(label: str, phrase: str) -> Column:
        def at(i: Column) -> Column:
            same = [F.get(tokens, i + k) == w for k, w in enumerate(phrase.split())]
            return F.coalesce(reduce(and_, same), F.lit(False))

        starts = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), at)
        return F.transform(
            starts,
            lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")),
        )

    return F.flatten(F.array(*[of(*item) for item in phrases.items()]))


def _frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many texts each token of the templates stands."""
    found = docs.select(
        F.explode(F.array_intersect(F.lit(vocabulary), words(F.col("text")))).alias("token")
    )
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}


def _kept(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns and the lower-cased text. Some names are the scan's own."""
    taken = {c.lower() for c in keep} & OWN_NAMES
    if taken:
        raise ValueError(f"kept columns {sorted(taken)} clash with the scan's; rename them first")
    return docs.select(*keep, lower_ascii(F.col(text)).alias("text"))


def matches(
    docs: DataFrame,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """A row per line and template that match: ``keep``, block, template, label, share.

    ``block`` is the line's number from 0, ``share`` the part of the template's tokens
    that the line has. Null and empty texts match nothing; equal rows match alike. What
    the driver learns is a count per template token.
    """
    rows = _kept(docs, text, keep)
    lines = rows.select(*keep, F.posexplode(F.split("text", "\n")).alias("block", "line"))
    blocks = lines.select(*keep, "block", words(F.col("line")).alias("before"), _no_words().alias("after"))
    return _joined(blocks, *_index(rows, templates, threshold), keep)


def block_matches(
    docs: DataFrame,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``matches``, and a row per line end and template that match across it.

    Of a template of n words, the last n - 1 words before a line's end and the first
    n - 1 after it are judged together, over as many lines as they fill; so every n
    words in a row are judged, wherever they are wrapped. Lines without words are passed
    over; ``block`` counts the lines with words, then the ends of all but the last.
    """
    rows = _kept(docs, text, keep)
    longest = max((len(t.split()) for _, t in templates), default=1)
    reach = max(longest - 1, 1)
    lines = F.transform(F.split("text", "\n"), words)
    own = rows.select(*keep, F.filter(lines, lambda w: F.size(w) > 0).alias("lines"))
    own = own.withColumn("heads", F.transform("lines", lambda w: F.slice(w, 1, reach)))
    last = F.size("lines") - 1

    def end(i: Column) -> Column:
        before = F.get("lines", i)
        left = F.least(F.size(before), F.lit(reach))
        after = F.flatten(F.slice("heads", i + 2, F.lit(reach)))
        return F.struct(
            F.slice(before, F.size(before) - left + 1, left).alias("before"),
            F.slice(after, 1, reach).alias("after"),
        )

    none = F.lit([]).cast("array<struct<before:array<string>,after:array<string>>>")
    ends = F.when(last > 0, F.transform(F.sequence(F.lit(0), last - 1), end)).otherwise(none)
    whole = F.transform("lines", lambda w: F.struct(w.alias("before"), _no_words().alias("after")))
    blocks = own.select(*keep, F.posexplode(F.concat(whole, ends)).alias("block", "words"))
    blocks = blocks.select(*keep, "block", "words.before", "words.after")
    return _joined(blocks, *_index(rows, templates, threshold), keep)


def _no_words() -> Column:
    return F.lit([]).cast("array<string>")


def _index(rows: DataFrame, templates, threshold: float) -> tuple[DataFrame, list[str], int]:
    """The templates by the tokens of their prefixes, the order of tokens, the least need."""
    spark = rows.sparkSession
    known = _templates(templates, threshold)
    sizes = [len(text.split()) for _, text in templates if text.split()]
    vocabulary = sorted({t for _, tokens, _ in known for t in tokens})
    counts = _frequencies(rows, vocabulary)
    order = sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}
    postings = [
        (token, i, number, label, ordered, need, size)
        for number, ((label, tokens, need), size) in enumerate(zip(known, sizes, strict=True))
        for ordered in [sorted(tokens, key=rank.__getitem__)]
        for i, token in enumerate(ordered[: len(ordered) - need + 1])
    ]
    index = spark.createDataFrame(
        postings,
        "token string, at int, template int, label string, tokens array<string>, need int, n int",
    )
    return index, order, min((need for *_, need in known), default=1)


def _joined(
    blocks: DataFrame, index: DataFrame, order: list[str], least: int, keep: tuple[str, ...]
) -> DataFrame:
    """The blocks' words ``before`` and ``after`` a line's end, joined with the templates."""
    # Only tokens of templates can be shared; array_intersect keeps the global order.
    known_order = F.lit(order).cast("array<string>")
    own = F.array_intersect(known_order, F.concat("before", "after"))
    length = F.greatest(F.size("own") - least + 1, F.lit(0))
    prefix = blocks.select(*keep, "block", "before", "after", own.alias("own")).select(
        *keep,
        "block",
        "before",
        "after",
        "own",
        F.posexplode(F.slice("own", F.lit(1), length)).alias("place", "token"),
    )
    # The templates come from the driver and are few; the blocks stay where they are.
    joined = prefix.join(F.broadcast(index), "token")
    left = F.least(F.size("own") - F.col("place"), F.size("tokens") - F.col("at"))
    both = F.array_intersect("own", "tokens")
    # The first shared token alone stands for the pair, so none is counted twice.
    found = joined.where(left >= F.col("need")).where(
        (F.get(both, F.lit(0)) == F.col("token")) & (F.size(both) >= F.col("need"))
    )
    # Across a line's end only words within the template's size of it count.
    near = F.least(F.col("n") - 1, F.size("before"))
    ahead = F.slice("after", F.lit(1), F.col("n") - 1)
    across = F.concat(F.slice("before", F.size("before") - near + 1, near), ahead)
    within = F.when(F.size("after") > 0, F.array_intersect("tokens", across)).otherwise(both)
    hit = F.size(within)
    return found.where(hit >= F.col("need")).select(
        *keep, "block", "template", "label", (hit / F.size("tokens")).alias("share")
    )


def _labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")


def scan(
    docs: DataFrame,
    text: str = "text",
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """License labels of every document, from its phrases and from matching templates.

    Templates are looked for in lines and, for wrapped notices, across their ends.
    ``score`` is the largest share of a template among the matches, 1 with a phrase and
    0 without either. Null text is empty: no words, null places, empty labels. A null
    doc_id is kept; repeated rows are each reported; other columns are left out.
    """
    rows = docs.select("doc_id", F.coalesce(lower_ascii(F.col(text)), F.lit("")).alias("text"))
    # Rows of one doc_id are told apart by their text.
    rows = rows.withColumn("text_id", F.md5(F.col("text").cast("binary")))
    hits = (
        block_matches(rows, templates, threshold, keep=("doc_id", "text_id"))
        .groupBy("doc_id", "text_id")
        .agg(
            F.collect_set("label").alias("found"),
            F.max("share").alias("share"),
        )
        .withColumnsRenamed({"doc_id": "hit_doc", "text_id": "hit_text"})
    )
    none = F.lit([]).cast("array<struct<start:bigint,label:string>>")
    with_words = rows.select("doc_id", "text_id", "text", words(F.col("text")).alias("words"))
    has = F.contains("text", F.lit("license")) & (F.size("words") > 0)
    based = with_words.select(
        "doc_id",
        "text_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(has, places(F.col("words"))).otherwise(none).alias("base"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_doc")) & (F.col("text_id") == F.col("hit_text"))
    labels = F.coalesce("found", F.lit([]).cast("array<string>"))
    base_labels = F.transform("base", lambda b: b["label"])
    starts = F.transform("base", lambda b: b["start"])
    return based.join(hits, same, "left").select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base_labels).alias("base_labels"),
        _labels(F.concat(base_labels, labels)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )

"""The pipeline's stages, one by one, against plain versions of each."""

import numpy as np

import corpus_pipeline as cp
from conftest import DATA
from roadevents.llm import suffixes as sx
from test_decontaminate import slow_tiles
from test_near_duplicates import shingle_set, roots

FOLDER = f"{DATA}/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans int"


def rows_of(df):
    return sorted(tuple(r) for r in df.select("doc_id", "text").collect())


def one_of_each(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    of = roots(len(rows), links)
    least = {r: min(d for (d, _), o in zip(rows, of) if o == r) for r in of}
    return sorted((d, t) for (d, t), r in zip(rows, of) if d == least[r])


def without_repeats(rows):
    seen, out = set(), []
    for doc, text in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - sx.LENGTH + 1):
            own = data[at : at + sx.LENGTH]
            if own in seen:
                gone[at : at + sx.LENGTH] = True
            seen.add(own)
        kept = bytes(b for b, g in zip(data, gone) if not g).decode(errors="ignore")
        if kept or not gone.any():
            out.append((doc, kept))
    return sorted(out)


def clean(rows, items):
    def covered(text):
        b = text.encode().lower().split()
        for own in items:
            a = own.encode().lower().split()
            runs = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (a, b)]
            if len(runs[0] & runs[1]) > 3:
                if sum(t[2] for t in slow_tiles(a, b, 4)) >= 0.5 * len(a):
                    return True
        return False

    return sorted(r for r in rows if not covered(r[1]))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    expected = [r for r in rows_of(docs) if any(c.isalpha() for c in r[1])]
    plain = [lambda r: r, one_of_each, without_repeats, lambda r: clean(r, items)]
    for (name, stage), slow in zip(cp.STAGES[:-1], plain):
        docs = cp.written(stage(spark, docs, FOLDER), name)
        expected = slow(expected)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert rows_of(docs) == expected, name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    result = cp.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in result} == {d for d, _ in expected}


def test_odd_rows_in_every_stage(spark):
    odd = [
        (1, "ab cd ef gh ij " * 20, "en", "s", 5, 1),
        (1, "ab cd ef gh ij " * 20, "en", "s", 5, 1),
        (2, None, None, None, None, None),
        (3, "", "en", "s", 0, 2),
        (None, "a text without a number", "en", "s", 9, 3),
        (4, "1 2 3 !", "en", "s", 9, 3),
        (5, "word " * 30_000, "en", None, 9, 3),
    ]
    docs = spark.createDataFrame(odd, SCHEMA)
    left = {"language_id": 4 + 0, "near_duplicates": 6, "suffix_dedup": 7, "decontamination": 7}
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns
        assert got.count() == left[name], name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert cp.STAGES[-1][1](spark, docs, FOLDER).count() >= 7


def test_near_copies_without_an_id_or_with_one_id(spark):
    dice = np.random.default_rng(3)

    def texts():
        words = [f"w{n}" for n in dice.integers(0, 10**9, 200)]
        return " ".join(words), " ".join(words[:-1]), " ".join(words[1:])

    a, b, c, d = (texts() for _ in range(4))
    rows = [
        # Two null ids linked with each other; one linked with 3; another id-less text.
        (None, a[0]), (None, a[1]), (3, b[0]), (None, b[1]), (None, "a text of its own"),
        # One id on two texts: one a near copy of a smaller id, the other unlinked.
        (4, c[0]), (5, c[1]), (5, "nothing like it"),
        # One id on two near copies.
        (6, d[0]), (6, d[2]),
    ]
    docs = spark.createDataFrame([(*r, "en", "s", 5, 1) for r in rows], SCHEMA)
    got = [tuple(r) for r in cp.near_duplicate(spark, docs, FOLDER).select("doc_id", "text").collect()]
    assert len(got) == len(set(got)) == 6
    assert len({(None, a[0]), (None, a[1])} & set(got)) == 1
    assert len({(6, d[0]), (6, d[2])} & set(got)) == 1
    assert {(3, b[0]), (None, "a text of its own"), (4, c[0]), (5, "nothing like it")} < set(got)


def test_without_labelled_rows_only_texts_without_a_letter_go(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "some words", None, "s", 5, 1), (2, "1 2 !", None, "s", 5, 1), (3, None, None, "s", 5, 1)],
        SCHEMA,
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = cp.language(spark, docs, str(tmp_path)).collect()
    assert [r["doc_id"] for r in got] == [1]


def test_columns_with_the_stages_own_names(spark):
    names = ["text_id", "_text_id", "copy", "missing", "kept", "kept_text", "spans", "lang_pred", "score"]
    docs = spark.createDataFrame([(1, "some words here", "en", "s", 5), (2, "other words", "fr", "s", 5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", *[f"{i} AS {n}" for i, n in enumerate(names)])
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns, name
        assert {tuple(r[n] for n in names) for r in got.collect()} == {tuple(range(len(names)))}, name
        assert got.count() == 2


def test_a_missing_language_is_filled_in(spark):
    known = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars > 500").limit(30)
    blank = known.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "source", "n_chars")
    wanted = {r.doc_id: r.lang for r in known.collect()}
    got = {r.doc_id: r.lang for r in cp.language(spark, blank, FOLDER).collect()}
    assert sum(got[d] == wanted[d] for d in wanted) >= len(wanted) - 1
    kept = {r.doc_id: r.lang for r in cp.language(spark, known, FOLDER).collect()}
    assert kept == wanted


def test_which_of_two_equal_documents_stays_does_not_depend_on_order(spark):
    rows = [(1, "some words that are equal here", "en", f"s{i}", i, i) for i in range(8)]
    stays = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, SCHEMA).repartition(3)
        stays.add(tuple(cp.near_duplicate(spark, docs, FOLDER).first()))
    assert len(stays) == 1

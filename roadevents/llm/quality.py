"""Quality rules whose cutoffs follow each language and source.

Every text is measured by whole numbers. A sketch of a measure is a histogram over
buckets that are exact up to 64 and a thirty-second wide above; two sketches are merged by
adding their counts, so they are built in map tasks, per language and source, and again
per language and over everything by merging. Quartiles read from a sketch give the fences
that a text must stay within, and these are joined to the texts. DataFrame functions only.

Null and empty texts have no words and fail the base rule. Null languages and sources are
groups of their own. Equal rows are judged alike. A text of any length is measured whole,
as one row of its task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
WINDOW = 3
EXACT_BITS = 6
GROUP = ("lang", "source")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A measure per thousand of another and how far from the quartiles it may lie.

    The fence stands ``reach`` times the distance of the quartiles beyond them, but at
    least ``low`` below the first or ``high`` above the third; None: no fence there.
    """

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None
    reach: int = 3

    def value(self) -> Column:
        share = F.expr(f"1000 * {self.part} div {self.whole}")
        return F.when(F.col(self.whole) > 0, share).otherwise(F.lit(0).cast("long"))


RULES = (
    Rule("symbols", "n_symbols", "n_words", None, 100),
    Rule("word_length", "word_chars", "n_words", 2000, 2000),
    Rule("dup_lines", "n_dup_lines", "n_lines", None, 500),
    Rule("repeats", "n_repeat_words", "n_words", None, 300),
)
# Groups of fewer texts are judged by the fences of their language, or of all texts.
MIN_TEXTS = 200


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated(words: Column) -> Column:
    """How many words lie in runs of ``WINDOW`` words that occur again in the text.

    A run is its hash. For sorting, the hash's last bits give way to the run's place, so
    equal runs become neighbours; whole hashes are then compared at the places.
    """

    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    def again(hashes: Column) -> Column:
        def sort(mask: Column) -> Column:
            def mark(h: Column, i: Column) -> Column:
                return h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))

            def at(x: Column) -> Column:
                return x.bitwiseAND(mask).cast("int")

            def twins(ordered: Column) -> Column:
                def same(x: Column, other: Column) -> Column:
                    equal = F.get(hashes, at(x)) == F.get(hashes, at(F.get(ordered, other)))
                    return F.coalesce(equal, F.lit(False))

                kept = F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1))
                return _let(F.sort_array(F.transform(kept, at)), _spanned)

            return _let(F.sort_array(F.transform(hashes, mark)), twins)

        bits = F.length(F.bin(F.size(hashes)))
        return _let(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, sort)

    runs = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), run)
    return F.when(F.size(words) > WINDOW, _let(runs, again)).otherwise(F.lit(0).cast("long"))


def _spanned(starts: Column) -> Column:
    """How many words the runs at the sorted ``starts`` cover together."""

    def width(start: Column, i: Column) -> Column:
        return F.least(F.coalesce(F.get(starts, i + 1) - start, F.lit(WINDOW)), F.lit(WINDOW))

    return F.aggregate(F.transform(starts, width), F.lit(0).cast("long"), lambda n, g: n + g)


def _measures(text: Column) -> Column:
    """All measures of a text as a struct of longs."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.array_distinct(lines)).cast("long").alias("distinct_lines"),
            _repeated(words).alias("n_repeat_words"),
        )

    return _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of)


def _require_free(df: DataFrame, *names: str) -> None:
    taken = {c.lower() for c in df.columns} & set(names)
    if taken:
        raise ValueError(f"columns {sorted(taken)} have the names of measures; rename them first")


def measured(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the measures of each row's ``text``.

    ``n_dup_lines`` are lines with a word that equal an earlier line, ``n_repeat_words``
    words in runs of three that occur twice or more. Kept columns must not have the
    measures' names.
    """
    kept = docs.select(*keep)
    _require_free(kept, *MEASURES, "base_failed", "kept")
    found = docs.select(*keep, _measures(F.col(text)).alias("measures"))
    values = {m: F.col(f"measures.{m}") for m in MEASURES if m != "n_dup_lines"}
    values["n_dup_lines"] = F.col("measures.n_lines") - F.col("measures.distinct_lines")
    return found.select(*keep, *[values[m].alias(m) for m in MEASURES])


def base_failed() -> Column:
    """The fixed rule: too few words, or too many in repeated runs."""
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def bucket(value: Column) -> Column:
    """The least value of the bucket of a whole number."""
    shift = F.greatest(F.length(F.bin(value)) - EXACT_BITS, F.lit(0))
    high = F.call_function("shiftright", value, shift)
    return F.call_function("shiftleft", high, shift)


def sketches(rows: DataFrame, by: Sequence[str] = GROUP, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``by``, rule, bucket and how many rows of ``measured`` columns fall in it."""
    values = [F.struct(F.lit(r.name).alias("rule"), bucket(r.value()).alias("bucket")) for r in rules]
    each = rows.select(*by, F.explode(F.array(*values)).alias("at")).select(*by, "at.*")
    return each.groupBy(*by, "rule", "bucket").agg(F.count("*").alias("n"))


def merged(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, by adding those of finer ones."""
    return found.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))


def fences(found: DataFrame, by: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """``by``, ``texts`` and per rule its ``_low`` and ``_high`` fence.

    A quartile is the smallest bucket up to which a quarter, or three, of the rows lie.
    """
    total = F.sum("n").alias("texts")
    counted = found.groupBy(*by, "rule").agg(
        total, F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("buckets")
    )
    # A sketch has some hundred buckets at most.
    before = "aggregate(slice(buckets, 1, i + 1), 0L, (a, x) -> a + x.n)"
    at = "filter(buckets, (b, i) -> 4 * {0} >= {1} * texts)[0].bucket".format
    q = counted.withColumns({"q1": F.expr(at(before, 1)), "q3": F.expr(at(before, 3))})
    ends = []
    for r in rules:
        reach = r.reach * (F.col("q3") - F.col("q1"))
        for name, slack, end in (
            (f"{r.name}_low", r.low, F.col("q1") - F.greatest(reach, F.lit(r.low))),
            (f"{r.name}_high", r.high, F.col("q3") + F.greatest(reach, F.lit(r.high))),
        ):
            if slack is not None:
                ends.append(F.max(F.when(F.col("rule") == r.name, end)).alias(name))
    return q.groupBy(*by).agg(F.max("texts").alias("texts"), *ends)


def cutoffs(
    rows: DataFrame, rules: Sequence[Rule] = RULES, min_texts: int = MIN_TEXTS
) -> DataFrame:
    """Per language and source: the fences that hold there, and the texts they rest on.

    Learnt from the rows that pass the base rule. A group with fewer than ``min_texts`` of
    them takes the fences of its language, and a language with fewer those of all texts.
    """
    lang, source = GROUP
    found = written(sketches(rows.where(~base_failed()), GROUP, rules), "quality-sketches")

    def level(name: str, *by: str) -> DataFrame:
        ends = fences(merged(found, by), by, rules)
        ends = ends.select(*by, F.struct(*[c for c in ends.columns if c not in by]).alias(name))
        return ends.select(*[F.col(c).alias(f"{name}_{c}") for c in by], name)

    def alike(name: str, *by: str) -> Column:
        return reduce(and_, [F.col(c).eqNullSafe(F.col(f"{name}_{c}")) for c in by])

    def enough(name: str) -> Column:
        return F.when(F.col(f"{name}.texts") >= min_texts, F.col(name))

    groups = rows.select(*GROUP).distinct()
    joined = groups.join(level("own", lang, source), alike("own", lang, source), "left")
    joined = joined.join(level("wide", lang), alike("wide", lang), "left")
    # The fences of all texts are a few numbers.
    overall = fences(merged(found, ()), (), rules).first()
    every = F.struct(*[F.lit(v).cast("long").alias(c) for c, v in overall.asDict().items()])
    fit = F.coalesce(enough("own"), enough("wide"), every).alias("fit")
    return joined.select(*GROUP, fit).select(*GROUP, "fit.*")


def verdicts(rows: DataFrame, ends: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows with ``base_failed``, ``kept`` and ``broken``, the rules they break."""
    lang, source = GROUP
    ends = ends.withColumnsRenamed({c: f"_{c}" for c in ends.columns})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (lang, source)]
    joined = rows.join(ends, reduce(and_, same), "left")
    broken = []
    for r in rules:
        out = F.lit(False)
        if r.low is not None:
            out = out | F.coalesce(r.value() < F.col(f"_{r.name}_low"), F.lit(False))
        if r.high is not None:
            out = out | F.coalesce(r.value() > F.col(f"_{r.name}_high"), F.lit(False))
        broken.append(F.when(out, r.name))
    judged = joined.withColumns({"base_failed": base_failed(), "broken": F.concat_ws(",", *broken)})
    kept = ~F.col("base_failed") & (F.col("broken") == "")
    return judged.select(*rows.columns, "base_failed", kept.alias("kept"), "broken")


def report(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, the measures, ``base_failed``, ``kept`` and ``broken`` of every row.

    Texts are read once: their measures are written, then sketched and judged. An empty
    table gives no rows.
    """
    extra = [c for c in GROUP if c not in keep]
    rows = written(measured(docs, text, (*keep, *extra)), "quality-measures")
    return verdicts(rows, cutoffs(rows)).drop(*extra)


def filtered(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text the rules keep, with their own columns alone.

    The fences are learnt in a first pass over the texts, which writes numbers only.
    """
    ends = cutoffs(written(measured(docs, text, GROUP), "quality-measures"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = docs.select(row, *[F.col(c).alias(c) for c in GROUP], F.col(text).alias("text"))
    judged = verdicts(measured(held, "text", ("row", *GROUP)), ends)
    return judged.where("kept").select("row.*")

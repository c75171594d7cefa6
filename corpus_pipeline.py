"""A corpus run from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadevents.llm.common import table, written
from roadevents.llm.decontaminate import uncontaminated
from roadevents.llm.language_id import DIMENSIONS, UNKNOWN, identify, is_held_out, train
from roadevents.llm.near_duplicates import representatives
from roadevents.llm.packing import pack_documents
from roadevents.llm.suffixes import deduplicated


def _unused(docs: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each behind as many underscores as no column of the table has."""
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        while name in taken:
            name = f"_{name}"
        return name

    return tuple(free(n) for n in names)


def _columns(docs: DataFrame) -> dict[str, Column]:
    return {c: F.col(f"`{c}`") for c in docs.columns}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no language: those without text, or without a letter in it.

    Documents that have no ``lang`` get the language they are identified as, by profiles
    of all labelled documents. Where no labelled text exists to learn from, every text with
    a letter stays, as it is.
    """
    labelled = table(spark, sf_dir, "documents")
    profiles = train(labelled.where(~is_held_out(F.col("doc_id"))))
    columns = _columns(docs)
    pred, score = _unused(docs, "lang_pred", "score")
    # Any profile tells texts with a letter from those without.
    found = identify(
        docs, profiles or {"any": [1] * DIMENSIONS}, keep=tuple(docs.columns), pred=pred, score=score
    )
    if profiles and "lang" in columns:
        columns["lang"] = F.coalesce(columns["lang"], F.col(pred)).alias("lang")
    return found.where(F.col(pred) != UNKNOWN).select(*columns.values())


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that links connect: that of the smallest doc_id.

    Rows are told apart by doc_id and text: of a group's rows of one doc_id, or of none,
    the smallest digest of the text stays. A null doc_id stays only where no row of its
    group has another. Of rows equal in both one stays: that whose columns have the
    smallest hash. Documents without words are linked with nothing and stay.
    """
    columns = _columns(docs)
    text_id, copy, doc, own = _unused(docs, "text_id", "copy", "kept_id", "kept_text_id")
    keyed = docs.withColumn(text_id, F.unhex(F.md5(F.col("text").cast("binary"))))
    found = representatives(keyed, text_id=text_id)
    found = found.select(F.col("doc_id").alias(doc), F.col("text_id").alias(own))
    row = F.col("doc_id").eqNullSafe(F.col(doc)) & F.col(text_id).eqNullSafe(F.col(own))
    kept = keyed.join(found, row, "left_semi")
    same = Window.partitionBy("doc_id", text_id).orderBy(F.xxhash64(*columns.values()))
    numbered = kept.withColumn(copy, F.row_number().over(same))
    return numbered.where(F.col(copy) == 1).select(*columns.values())


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what also starts earlier; texts of which nothing is left go."""
    columns = _columns(docs)
    missing, kept, text, spans = _unused(docs, "missing", "kept", "kept_text", "spans")
    columns["text"] = F.when(~F.col(missing), F.col(text)).alias("text")
    if "n_chars" in columns:
        size = F.length(columns["text"]).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = size.alias("n_chars")
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    marked = docs.withColumn(missing, F.col("text").isNull())
    found = deduplicated(marked, keep=(*rest, missing), names=(kept, text, spans))
    left = (F.size(spans) == 0) | (F.col(text) != "")
    return found.where(left).select(*columns.values())


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that cover a benchmark item."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token sequences."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicate),
    ("suffix_dedup", repeated_text),
    ("decontamination", decontaminated),
    ("packing", packed),
]

# Tokenisation and the profiles are out of SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each on what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

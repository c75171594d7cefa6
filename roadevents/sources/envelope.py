"""Poll responses landed as JSON: ``{"body": {"items": [record, ...]}}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadevents.schema import ENVELOPE_SCHEMA, FIELDS

POSITION = "seq"


def flatten(responses: DataFrame) -> DataFrame:
    """One row per record, with its position in the response as ``seq``.

    A response without a body or items gives no rows.
    """
    extra = [c for c in responses.columns if c != "body"]
    items = responses.select(
        *extra, F.posexplode("body.items").alias(POSITION, "item")
    )
    return items.select(*[F.col(f"item.{f}").alias(f) for f in FIELDS], POSITION, *extra)


def json_envelope(
    spark: SparkSession, path: str, *, one_per_line: bool = False
) -> DataFrame:
    """Records of every response under ``path``; ``file`` names the response's file.

    A file is one response, or holds one response per line (``one_per_line``), which
    lets Spark split large files. Partition folders become columns.
    """
    responses = (
        spark.read.schema(ENVELOPE_SCHEMA)
        .option("multiLine", not one_per_line)
        .json(path)
    )
    return flatten(responses.withColumn("file", F.col("_metadata.file_path")))

"""Few files instead of many: days to which many polls have appended are written anew.

For stored tables and archived days. A landing area that a stream or a ledger watches is
left alone until its day has been loaded: rewritten files would look like new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.schema import FIELDS
from roadevents.session import path_has_files
from roadevents.sinks.files import PARTITION, land_csv
from roadevents.sources.csv_files import csv_by_name, require_whole_records
from roadevents.sources.records import listing

MAX_FILES = 8
# Days whose files are this large on average need no compaction.
LARGE_BYTES = 128 << 20

FILES = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)


def day_files(spark: SparkSession, path: str, kind: str, partition: str = PARTITION) -> DataFrame:
    """Per day folder its files and their bytes, from the listing alone."""
    if not path_has_files(spark, path):
        return spark.createDataFrame([], FILES)
    day = F.regexp_extract("path", f"/{partition}=([^/]*)/[^/]*$", 1)
    found = listing(spark, path, f"*.{kind}").select(day.alias("day"), "length")
    grouped = found.where(F.col("day") != "").groupBy("day")
    return grouped.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def compact_days(
    spark: SparkSession,
    path: str,
    kind: str = "parquet",
    *,
    schema: T.StructType | None = None,
    partition: str = PARTITION,
    max_files: int = MAX_FILES,
    large_bytes: int = LARGE_BYTES,
) -> list[str]:
    """Rewrites the days with more than ``max_files`` files, unless these are large; the days.

    A day's rows stay the same; a large day keeps several files. Days are replaced when
    their new files are complete: a run that fails leaves them as they were, and one that
    is repeated finds nothing to do. ``kind="csv"`` is for landed records, bound by their
    names; a day with a record of a wrong number of values fails and stays. ``schema`` are
    the columns of Parquet files, by default those that the files have.
    """
    if kind not in ("parquet", "csv"):
        raise ValueError(f"kind must be 'parquet' or 'csv', not {kind!r}")
    small = F.col("bytes") < F.lit(large_bytes) * F.col("files")
    found = day_files(spark, path, kind, partition).where((F.col("files") > max_files) & small)
    # A value for each day of the calendar that needs it.
    days = sorted(r["day"] for r in found.collect())
    if not days:
        return []
    null = "__HIVE_DEFAULT_PARTITION__"
    chosen = F.col(partition).cast("string").isin([d for d in days if d != null])
    if null in days:
        chosen = chosen | F.col(partition).isNull()
    if kind == "csv":
        raw = csv_by_name(spark, path, headers="per_file", partition_columns=[partition])
        land_csv(require_whole_records(raw.where(chosen)).select(*FIELDS, partition), path)
        return days
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(partition, T.DateType())]))
    (
        reader.parquet(path)
        .withColumn(partition, F.col(partition).cast("date"))
        .where(chosen)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    return days

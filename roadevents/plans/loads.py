"""The recurring loads, from landed files to a stored table.

Each takes the day it works for as an argument, so writing and reading the raw zone
cannot disagree about it around midnight.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadevents.operators.dedup import dedup_first
from roadevents.operators.normalize import CORRUPT, REASON, normalize, rejects
from roadevents.operators.quality import require_rows
from roadevents.schema import FIELDS, MERGE_KEYS, NULL_MARKERS, NUMBER_BLANKS, TEXT_DATE_SCHEMA
from roadevents.sinks import files, ledger, upsert
from roadevents.sources.archives import zip_csv
from roadevents.sources.csv_files import (
    csv_by_name,
    csv_by_position,
    require_whole_records,
)
from roadevents.sources.envelope import json_envelope
from roadevents.sources.parquet_files import parquet_by_name

Day = dt.date | str


def day_folder(raw_zone: str, day: Day) -> str:
    return f"{raw_zone.rstrip('/')}/{files.PARTITION}={day}"


def _record_fields(raw: DataFrame) -> DataFrame:
    return raw.select(*FIELDS)


def refresh_raw(spark: SparkSession, prefix: str, table: str) -> None:
    """Replaces the all-text table by the content of every CSV file under a prefix.

    A record with a wrong number of values fails the load; the table then stays.
    """
    raw = require_whole_records(csv_by_position(spark, prefix))
    files.full_refresh(_record_fields(raw), table)


def load_snapshot(
    spark: SparkSession, csv_path: str, table: str, *, stamp: Column | None = None
) -> None:
    """Adds one poll's CSV to the central table, keeping the latest row per key.

    A record that does not convert, or has a wrong number of values, fails the load
    before the table changes.
    """
    batch = normalize(csv_by_position(spark, csv_path), on_error="abort")
    upsert.rewrite_latest(_record_fields(batch), table, stamp=stamp)


def load_append(
    spark: SparkSession,
    responses: str,
    raw_zone: str,
    table: str,
    day: Day,
    *,
    rejects_table: str | None = None,
    null_markers: Sequence[str] = NULL_MARKERS,
    **json_options,
) -> None:
    """Lands poll responses as the day's CSV, then appends that day to the table.

    Records that do not convert are left out; ``rejects_table`` collects them.
    """
    records = require_rows(json_envelope(spark, responses, **json_options))
    files.land_csv(_record_fields(records), raw_zone, day)
    files.create_if_absent(spark, table, TEXT_DATE_SCHEMA)
    landed = csv_by_name(spark, day_folder(raw_zone, day))
    options = {"dates": "text", "null_markers": null_markers}
    files.append_load(normalize(landed, **options), table)
    if rejects_table:
        files.append_load(rejects(landed, **options), rejects_table)


def load_new_files(
    spark: SparkSession,
    raw_zone: str,
    table: str,
    *,
    rejects_table: str | None = None,
    null_markers: Sequence[str] = NULL_MARKERS,
    **csv_options,
) -> int:
    """Appends the CSV files under ``raw_zone``, or a day of it, that no load has taken yet;
    how many these are. Running it again adds nothing.

    Files bind by their own headers. Records that do not convert are left out;
    ``rejects_table`` collects them under the same load. Both tables are read through
    ``sinks.ledger.loaded``.
    """
    options = {"dates": "text", "null_markers": null_markers}

    def build(paths: list[str]) -> dict[str, DataFrame]:
        raw = csv_by_name(spark, paths, headers="per_file", **csv_options)
        found = {table: normalize(raw, **options)}
        if rejects_table:
            found[rejects_table] = rejects(raw, **options)
        return found

    return ledger.load_once(spark, raw_zone, table, build)


def _oddly_spelled(landed: DataFrame) -> DataFrame:
    """Records whose link has a value that another text could have too, such as ``110.0``."""
    link = F.col("linkId")
    plain = link.rlike(r"\A(0|-?[1-9][0-9]*)\z")
    return landed.where(~link.isin(*NUMBER_BLANKS) & ~plain).select(link)


def load_merge(
    spark: SparkSession,
    responses: str,
    raw_zone: str,
    table: str,
    day: Day,
    *,
    stamp: Column | None = None,
    rejects_table: str | None = None,
    **json_options,
) -> None:
    """Lands poll responses as the day's Parquet without repeated keys beside the
    original CSV, then merges that day into the table.

    Spellings of one key (``110`` and ``110.0``) are one key: of the records landed the
    first, in text order of the link, is merged. The table must be
    one that only merges have written.
    """
    order = ("file", "seq")
    records = json_envelope(spark, responses, **json_options).select(*FIELDS, *order)
    # The responses are parsed once; a lost block is parsed again.
    records.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        files.land_deduplicated(require_rows(records), raw_zone, day, order)
        files.land_csv(_record_fields(records), raw_zone, day, mode="append")
    finally:
        records.unpersist()
    landed = parquet_by_name(spark, day_folder(raw_zone, day))
    batch = normalize(landed, dates="text")
    # Landed keys differ as text. Where every link is spelled plainly, so do their values.
    if not _oddly_spelled(landed).isEmpty():
        typed = normalize(landed.withColumn("_spelled", F.col("linkId")), dates="text")
        incomplete = reduce(or_, [F.col(k).isNull() for k in MERGE_KEYS])
        first = dedup_first(typed.where(~incomplete), MERGE_KEYS, ("_spelled",))
        batch = first.unionByName(typed.where(incomplete))
    upsert.merge_into(batch, table, stamp=stamp, unique_target=True, checked=True)
    if rejects_table:
        files.append_load(rejects(landed, dates="text"), rejects_table)


def land_archives(
    spark: SparkSession,
    archives: str,
    raw_zone: str,
    day: Day,
    *,
    rejects_table: str | None = None,
    **zip_options,
) -> None:
    """Lands the CSV entries of zip archives as the day's CSV.

    A record with a wrong number of values fails the load, and the day stays as it was.
    With ``rejects_table`` such records are added there, as their text with archive, entry
    and reason, and the others land.
    """
    entries = require_rows(zip_csv(spark, archives, **zip_options))
    if rejects_table is None:
        files.land_csv(_record_fields(require_whole_records(entries)), raw_zone, day)
        return
    files.land_csv(_record_fields(entries.where(F.col(CORRUPT).isNull())), raw_zone, day)
    bad = entries.where(F.col(CORRUPT).isNotNull())
    reason = F.lit("column_count").alias(REASON)
    files.append_load(bad.select("archive", "entry", F.col(CORRUPT).alias("record"), reason), rejects_table)

"""Incremental loads of newly landed poll files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadevents.operators.dedup import dedup_latest
from roadevents.operators.normalize import CORRUPT, normalize, rejects
from roadevents.schema import ENVELOPE_SCHEMA, FIELDS, MERGE_KEYS
from roadevents.sinks.files import PARTITION
from roadevents.sources.csv_files import READ_OPTIONS
from roadevents.sources.envelope import POSITION, flatten
from roadevents.sources.records import text_schema

BLOCK = "block"


def landed_stream(
    spark: SparkSession,
    landing: str,
    kind: str = "json",
    *,
    one_per_line: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Raw records of files under ``landing/ingestion_date=day/``, each file once.

    Adds ``polled_at`` and ``file``, the file's time and name. JSON files are poll
    responses (``seq`` is the position in the response); CSV files bind by position, and
    the text of a record with a wrong number of values is in ``_corrupt_record``.
    A file replaced under the same name is not seen again: land one file per poll.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    day = T.StructField(PARTITION, T.DateType())
    origin = {
        "polled_at": F.col("_metadata.file_modification_time").cast("timestamp_ntz"),
        "file": F.col("_metadata.file_path"),
    }
    if kind == "json":
        responses = (
            reader.schema(T.StructType([*ENVELOPE_SCHEMA.fields, day]))
            .option("multiLine", not one_per_line)
            .json(landing)
        )
        return flatten(responses.withColumns(origin))
    if kind == "csv":
        return (
            reader.schema(T.StructType([*text_schema(FIELDS).fields, day]))
            .options(**READ_OPTIONS, multiLine=not one_per_line)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(landing)
            .withColumns({**origin, BLOCK: F.col("_metadata.file_block_start")})
        )
    raise ValueError(f"kind must be 'json' or 'csv', not {kind!r}")


def _append(rows: DataFrame, out: str, number: int) -> None:
    """The rows of a micro-batch under its number below their days, in place of those that
    an earlier attempt at the same batch has left."""
    (
        rows.withColumn("batch", F.lit(number))
        .hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION, "batch")
        .parquet(out)
    )


def _started(stream: DataFrame, checkpoint: str, apply, query_name: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(apply)
    if query_name:
        writer = writer.queryName(query_name)
    return (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def start_append(
    stream: DataFrame, out: str, checkpoint: str, *, query_name: str | None = None
) -> StreamingQuery:
    """Appends everything landed so far to Parquet day folders, then stops.

    Rows are rebalanced by day, so a day gets few files. Each micro-batch has a folder of
    its own below its day, which a replay of the batch replaces.
    """
    return _started(stream, checkpoint, lambda batch, n: _append(batch, out, n), query_name)


def start_typed_append(
    stream: DataFrame,
    out: str,
    rejected: str,
    checkpoint: str,
    *,
    query_name: str | None = None,
    **options,
) -> StreamingQuery:
    """Appends the typed events landed so far to ``out`` and the records that do not
    convert, or have a wrong number of values, to ``rejected``; then stops.

    Both come from the same micro-batch, which is read once, and carry its number, so a
    replay replaces both: no record is in neither table, or in one twice. ``options`` are
    those of ``normalize``; the rejects have the raw text and the reason.
    """

    def apply(batch: DataFrame, number: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _append(rejects(batch, **options), rejected, number)
            _append(normalize(batch, **options), out, number)
        finally:
            batch.unpersist()

    return _started(stream, checkpoint, apply, query_name)


def latest_poll(
    batch: DataFrame, keys: Sequence[str] = MERGE_KEYS, *, incomplete: str = "grouped"
) -> DataFrame:
    """Per key the record of the latest poll, and within that poll the first one.

    One micro-batch may hold several polls of the same incident; with the poll stored
    beside the row this makes the outcome independent of how polls fall into batches.
    ``incomplete`` says what becomes of keys with a null part: ``"grouped"`` treats them
    as one key, ``"per_poll"`` keeps the first of every poll, for a merge in which they
    never match an earlier row.
    """
    if incomplete not in ("grouped", "per_poll"):
        raise ValueError(f"incomplete must be 'grouped' or 'per_poll', not {incomplete!r}")
    place = F.struct(-F.col(POSITION)) if POSITION in batch.columns else None
    if place is None:
        # Rows of one block are read by one task in order; blocks stand by their start.
        block = F.col(BLOCK) if BLOCK in batch.columns else F.lit(0)
        place = F.struct(-block, -F.monotonically_increasing_id())
    poll = F.struct(PARTITION, "polled_at", "file")
    ranked = batch.withColumns({"_poll": poll, "_place": place})
    if incomplete == "per_poll":
        missing = reduce(or_, [F.col(k).isNull() for k in keys])
        ranked = ranked.withColumn("_own_poll", F.when(missing, F.col("_poll")))
        keys = [*keys, "_own_poll"]
    latest = dedup_latest(ranked, keys, "_poll", tiebreak=("_place",))
    return latest.drop("_poll", "_place", "_own_poll")


def start_upsert(
    stream: DataFrame,
    checkpoint: str,
    apply_batch: Callable[[DataFrame], None],
) -> StreamingQuery:
    """Feeds each micro-batch of everything landed so far to ``apply_batch``.

    A batch may be replayed after a failure. With a stamp taken from the records
    (``polled_at``) rather than the clock, the replay leaves the table as it was.
    """
    return (
        stream.writeStream.foreachBatch(lambda batch, _: apply_batch(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

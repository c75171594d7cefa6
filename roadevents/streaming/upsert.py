"""Streaming forms of the two write policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadevents.operators.normalize import normalize
from roadevents.schema import CENTRAL_SCHEMA, LATEST_KEYS, MERGE_KEYS, MERGE_SCHEMA
from roadevents.sinks.files import PARTITION
from roadevents.sinks.upsert import merge_into, rewrite_latest
from roadevents.streaming.ingest import latest_poll, start_upsert

#: Which poll a stored row is from: its day, its file's time and name. Polls are ordered
#: by these, whatever micro-batch they come in, so late polls change nothing.
POLL = [
    T.StructField(PARTITION, T.DateType()),
    T.StructField("polled_at", T.TimestampNTZType()),
    T.StructField("file", T.StringType()),
]
RECENCY = tuple(f.name for f in POLL)
MERGED_SCHEMA = T.StructType([*MERGE_SCHEMA.fields, *POLL])
LATEST_SCHEMA = T.StructType([*CENTRAL_SCHEMA.fields, *POLL])


def stream_merge(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    *,
    null_markers: Sequence[str] = (),
    unique_target: bool = True,
) -> StreamingQuery:
    """Merges newly landed records into the table keyed by start and link.

    ``unique_target`` holds for a table that only merges have written.
    """

    def apply_batch(batch: DataFrame) -> None:
        typed = normalize(batch, dates="text", null_markers=null_markers)
        merge_into(
            latest_poll(typed, MERGE_KEYS, incomplete="per_poll"),
            table,
            stamp=F.col("polled_at"),
            unique_target=unique_target,
            schema=MERGED_SCHEMA,
            checked=True,
            replayable=True,
            recency=RECENCY,
        )

    return start_upsert(stream, checkpoint, apply_batch)


def stream_rewrite_latest(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    *,
    null_markers: Sequence[str] = (),
) -> StreamingQuery:
    """Adds newly landed records and keeps the latest row per start and position."""

    def apply_batch(batch: DataFrame) -> None:
        typed = normalize(batch, null_markers=null_markers)
        rewrite_latest(
            latest_poll(typed, LATEST_KEYS),
            table,
            stamp=F.col("polled_at").cast("timestamp"),
            schema=LATEST_SCHEMA,
            recency=RECENCY,
        )

    return start_upsert(stream, checkpoint, apply_batch)

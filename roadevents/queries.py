"""Registered queries: each reads the tables of a folder and returns a DataFrame.

Queries about files first have Spark write the incident view in the format at hand to
a new folder in the cluster's shared area.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.csv as pacsv
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.fixtures import AS_OF, as_text, dirty_text, fields_with, incident_events
from roadevents.functions import text
from roadevents.functions.text import stringify
from roadevents.operators import dedup, merge
from roadevents.operators.normalize import apply_null_markers, normalize, rejects
from roadevents.plans import incremental, loads, marts, models
from roadevents.plans.rollup import reports_in_one_pass
from roadevents.schema import EVENT_SCHEMA, FIELDS, NULL_MARKERS, TEXT_DATE_SCHEMA
from roadevents.session import qualified, shared_folder
from roadevents.sinks import bucketed, compact, files, ledger, upsert
from roadevents.sinks.tables import (
    create_table_if_absent,
    create_view,
    drop,
    empty_like,
    insert_by_name,
    materialize,
    publish,
)
from roadevents.sources import archives, csv_files, envelope, parquet_files, tables
from roadevents.streaming import ingest
from roadevents.streaming.changes import changed_records
from roadevents.streaming.upsert import stream_merge, stream_rewrite_latest

Query = Callable[[SparkSession, str], DataFrame]

POLL_SIZE = 500


def _mart(build: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, folder: build(
        incident_events(spark, folder), as_of=AS_OF, **options
    )


def _id() -> Column:
    return F.col("event_id")


def _revised(events: DataFrame) -> DataFrame:
    """Two events of three, polled again with another event type."""
    return events.where((_id() % 2 == 0) | (_id() % 3 == 0)).withColumn(
        "eventType", F.concat_ws("/", "eventType", F.lit("변경"))
    )


def normalize_typed(spark: SparkSession, folder: str) -> DataFrame:
    raw = dirty_text(incident_events(spark, folder))
    return normalize(raw, null_markers=NULL_MARKERS)


def load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    raw = dirty_text(incident_events(spark, folder))
    return rejects(raw, null_markers=NULL_MARKERS)


def null_markers(spark: SparkSession, folder: str) -> DataFrame:
    return apply_null_markers(dirty_text(incident_events(spark, folder)), NULL_MARKERS)


def stringify_all(spark: SparkSession, folder: str) -> DataFrame:
    return stringify(incident_events(spark, folder))


def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    raw = as_text(incident_events(spark, folder)).withColumn("seq", _id())
    copies = raw.where(_id() % 4 == 0).withColumns(
        {"seq": _id() + 1000000000000, "eventType": F.lit("copy")}
    )
    return dedup.with_unique_id(dedup.dedup_first(raw.unionByName(copies)))


def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    events = incident_events(spark, folder).withColumn("day", F.to_date("startDate"))
    return dedup.dedup_latest(
        events, ("day", "coordX", "coordY"), "startDate", ("event_id",)
    )


def _polls(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = incident_events(spark, folder).withColumn(
        "coordX", F.when(_id() % 10 != 0, F.col("coordX"))
    )
    return events.where(_id() % 3 != 0), _revised(events)


def _at(day: str) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp")


def _zone_free(df: DataFrame) -> DataFrame:
    return df.withColumn("createdAt", F.col("createdAt").cast("timestamp_ntz"))


def snapshot_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    existing, batch = _polls(spark, folder)
    return _zone_free(
        dedup.snapshot_latest(
            existing.withColumn("createdAt", _at("2024-01-31")),
            batch.withColumn("createdAt", _at("2024-02-01")),
        )
    )


def snapshot_rewrite_table(spark: SparkSession, folder: str) -> DataFrame:
    existing, batch = _polls(spark, folder)
    path = shared_folder(spark, "snapshot")
    upsert.rewrite_latest(existing, path, stamp=_at("2024-01-31"))
    upsert.rewrite_latest(batch, path, stamp=_at("2024-02-01"))
    return _zone_free(upsert.read_table(spark, path, upsert.CENTRAL_SCHEMA))


def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = incident_events(spark, folder)
    return dedup.distinct_rows(events.unionByName(events.where(_id() % 4 == 0)))


def _merge_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = incident_events(spark, folder).withColumn(
        "linkId", F.when(_id() % 13 != 0, F.col("linkId"))
    )
    return events.where(_id() % 3 != 0), _revised(events)


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _merge_inputs(spark, folder)
    doubled = target.unionByName(target.where(_id() % 30 == 1))
    stamped = doubled.withColumn("ingestion_timestamp", _ntz("2024-01-31 00:00:00"))
    return merge.merge_upsert(stamped, batch, stamp=_ntz(AS_OF))


def merge_table(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _merge_inputs(spark, folder)
    path = shared_folder(spark, "merge")
    stamp = T.StructField("ingestion_timestamp", T.TimestampNTZType())
    schema = T.StructType([*EVENT_SCHEMA.fields, stamp])
    options = {"schema": schema, "unique_target": True}
    upsert.merge_into(target, path, stamp=_ntz("2024-01-31 00:00:00"), **options)
    upsert.merge_into(batch, path, stamp=_ntz(AS_OF), **options)
    return upsert.read_table(spark, path, schema)


def merge_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _merge_inputs(spark, folder)
    name = f"merged_{shared_folder(spark, 'bucketed').rsplit('-', 1)[1]}"
    stamp = T.StructField("ingestion_timestamp", T.TimestampNTZType())
    schema = T.StructType([*EVENT_SCHEMA.fields, stamp])
    bucketed.create_bucketed(spark, name, schema, buckets=8)
    bucketed.merge_bucketed(target, name, stamp=_ntz("2024-01-31 00:00:00"), checked=True)
    bucketed.merge_bucketed(batch, name, stamp=_ntz(AS_OF))
    return spark.table(name).drop(upsert.DAY)


def _responses(text: DataFrame, *extra: str) -> DataFrame:
    """Poll responses as JSON text, each of at most ``POLL_SIZE`` consecutive events."""
    # Records become text before they are gathered: one value of a row instead of many.
    record = F.struct("event_id", F.to_json(F.struct(*FIELDS)).alias("record"))
    items = F.sort_array(F.collect_list(record))["record"]
    response = F.concat(F.lit('{"body":{"items":['), F.array_join(items, ","), F.lit("]}}"))
    return (
        text.groupBy(*extra, (_id() / POLL_SIZE).cast("bigint").alias("poll"))
        .agg(response.alias("value"))
        .select("value", *extra)
    )


def json_envelope(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "json")
    _responses(as_text(incident_events(spark, folder))).write.text(path)
    records = envelope.json_envelope(spark, path, one_per_line=True)
    return fields_with(normalize(records), "seq")


def _response_files(spark: SparkSession, folder: str) -> str:
    """Poll responses, each in a file of its own."""
    path = shared_folder(spark, "json")
    responses = _responses(as_text(incident_events(spark, folder)))
    responses.write.option("maxRecordsPerFile", 1).text(path)
    return path


def json_envelope_files(spark: SparkSession, folder: str) -> DataFrame:
    records = envelope.json_envelope(spark, _response_files(spark, folder))
    return fields_with(normalize(records), "seq")


def json_one_file(spark: SparkSession, folder: str) -> DataFrame:
    """The records of one response file among many: that of the first events."""
    records = envelope.json_envelope(spark, _response_files(spark, folder))
    number = F.regexp_extract("message", r'"(\d+)"', 1).cast("bigint")
    first = records.agg(F.min_by("file", number).alias("file")).first()["file"]
    return fields_with(normalize(envelope.json_envelope(spark, first)), "seq")


def csv_by_position(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    raw = fields_with(as_text(incident_events(spark, folder)))
    files.land_csv(raw, path, "2024-02-01")
    return normalize(csv_files.csv_by_position(spark, path), on_error="abort")


def _other_layout(raw: DataFrame) -> DataFrame:
    """Columns reversed and upper-cased, one missing and one unknown."""
    return raw.select(
        F.lit("x").alias("UNKNOWN"),
        *[F.col(f).alias(f.upper()) for f in reversed(FIELDS) if f != "roadNo"],
    )


def csv_by_name(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    raw = dirty_text(incident_events(spark, folder))
    files.land_csv(_other_layout(raw), path, "2024-02-01")
    records = csv_files.csv_by_name(spark, path)
    return normalize(records, dates="text", null_markers=NULL_MARKERS)


def csv_by_name_per_file(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    raw = as_text(incident_events(spark, folder))
    files.land_csv(fields_with(raw.where(_id() % 2 == 0)), path, "2024-01-31")
    files.land_csv(_other_layout(raw.where(_id() % 2 == 1)), path, "2024-02-01")
    records = csv_files.csv_by_name(
        spark, path, headers="per_file", partition_columns=["ingestion_date"]
    )
    return normalize(records, dates="text")


def parquet_by_name(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "parquet")
    raw = fields_with(as_text(incident_events(spark, folder)))
    records = dedup.with_unique_id(raw)
    files.land_parquet(records, path, "2024-02-01")
    files.land_csv(raw, path, "2024-02-01", mode="append")
    read = parquet_files.parquet_by_name(spark, path).drop("ingestion_date")
    return normalize(read)


def _write_zips(raw: DataFrame, path: str, header: Sequence[str] | None = None) -> None:
    """The records as zip archives of two CSV files each, written by the tasks.

    ``header`` are the names that the files begin with, if not those of the columns.
    """
    uri = qualified(raw.sparkSession, path)
    first = ",".join(f'"{name}"' for name in header or raw.columns).encode() + b"\n"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            packed, half = io.BytesIO(), batch.num_rows // 2
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                for entry, part in (("a/events.csv", batch[:half]), ("events.csv", batch[half:])):
                    text = io.BytesIO(first)
                    text.seek(0, io.SEEK_END)
                    pacsv.write_csv(part, text, pacsv.WriteOptions(include_header=False))
                    archive.writestr(entry, text.getvalue())
                archive.writestr("readme.txt", "not an entry to load")
            name = f"{folder}/{task}-{number}.zip"
            with store.open_output_stream(name) as file:
                file.write(packed.getvalue())
            yield pa.RecordBatch.from_pydict({"name": [name]})

    raw.mapInArrow(pack, "name string").count()


def zip_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "zips")
    _write_zips(fields_with(as_text(incident_events(spark, folder))), path)
    records = archives.zip_csv(spark, path)
    named = {"archive": F.substring_index("archive", ".", -1), "entry": F.substring_index("entry", "/", -1)}
    return normalize(records).withColumns(named)


def load_archives(spark: SparkSession, folder: str) -> DataFrame:
    path, zone = shared_folder(spark, "zips"), shared_folder(spark, "zone")
    _write_zips(fields_with(as_text(incident_events(spark, folder))), path)
    loads.land_archives(spark, path, zone, "2024-02-01")
    return normalize(csv_files.csv_by_position(spark, zone))


def _broken(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records of 14 values, of 15, and of 6."""
    more, less = _id() % 11 == 0, _id() % 13 == 0
    whole = fields_with(raw.where(~more & ~less))
    surplus = fields_with(raw.where(more)).withColumn("surplus", F.lit("x"))
    return whole, surplus, raw.where(~more & less).select(*FIELDS[:6])


def _loaded_and_refused(loaded: DataFrame, refused: DataFrame) -> DataFrame:
    """startDate, linkId and reason of typed rows and of rejects."""
    good = loaded.select("startDate", "linkId", F.lit("").alias("reason"))
    failed = refused.select(
        text.to_timestamp14(F.col("startDate")).alias("startDate"),
        F.lit(None).cast("bigint").alias("linkId"),
        F.col("reject_reason").alias("reason"),
    )
    return good.unionByName(failed)


def load_archives_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Archives whose records have 14, 15 or 6 values: what lands, and the rejects."""
    path, zone = shared_folder(spark, "zips"), shared_folder(spark, "zone")
    refused = shared_folder(spark, "refused")
    for part in _broken(as_text(incident_events(spark, folder))):
        _write_zips(part, f"{path}/{len(part.columns)}", FIELDS)
    loads.land_archives(spark, path, zone, "2024-02-01", rejects_table=refused)
    landed = normalize(csv_files.csv_by_position(spark, zone))
    # The fourth value of a record's text is its start; none before it holds a comma.
    start = F.get(F.split("record", ","), 3)
    failed = tables.table(spark, refused).withColumn("startDate", F.replace(start, F.lit('"'), F.lit("")))
    return _loaded_and_refused(landed, failed)


def load_snapshot_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Records of 14 values, and of 15 and 6, which are set aside with their reason."""
    path = shared_folder(spark, "csv")
    for part in _broken(as_text(incident_events(spark, folder))):
        files.land_csv(part, path, "2024-02-01", mode="append")
    records = csv_files.csv_by_position(spark, path)
    return _loaded_and_refused(normalize(records), rejects(records))


def hourly_event_heatmap_text(spark: SparkSession, folder: str) -> DataFrame:
    """The heatmap over dates as landed: short, blank, dashed, and hours above 23."""
    n, start = _id(), F.col("startDate")
    dashed = F.concat_ws("-", *[F.substring(start, i, k) for i, k in ((1, 4), (5, 2), (7, 8))])
    odd = (
        F.when(n % 41 == 0, "  ")
        .when(n % 43 == 0, F.substring(start, 1, 8))
        .when(n % 47 == 0, dashed)
        .when(n % 53 == 0, F.concat(F.substring(start, 1, 8), (n % 76 + 24).cast("string")))
    )
    raw = dirty_text(incident_events(spark, folder))
    return marts.hourly_event_heatmap(raw.withColumn("startDate", odd.otherwise(start)))


def partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "landing")
    events = incident_events(spark, folder)
    files.land_parquet(
        events.withColumn("ingestion_date", F.to_date("startDate")), path
    )
    return tables.in_partition(tables.table(spark, path), "2024-01-15")


def append_load(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "append")
    events = incident_events(spark, folder)
    files.create_if_absent(spark, path, events.schema)
    files.append_load(events.where(_id() % 3 != 0), path)
    files.append_load(_revised(events), path)
    return tables.table(spark, path)


def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    landing, path = shared_folder(spark, "csv"), shared_folder(spark, "refresh")
    raw = fields_with(as_text(incident_events(spark, folder)), "event_id")
    for day, rest in (("2024-01-31", 0), ("2024-02-01", 1)):
        files.land_csv(raw.where(_id() % 2 == rest).drop("event_id"), landing, day)
        loads.refresh_raw(spark, landing, path)
    return tables.table(spark, path)


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    landing, path = shared_folder(spark, "polls"), shared_folder(spark, "ingested")
    raw = as_text(incident_events(spark, folder)).withColumn(
        "ingestion_date", F.to_date(F.substring("startDate", 1, 8), "yyyyMMdd")
    )
    polls = _responses(raw, "ingestion_date")
    polls.write.partitionBy("ingestion_date").text(landing)
    stream = ingest.landed_stream(spark, landing, one_per_line=True)
    checkpoint = shared_folder(spark, "progress")
    ingest.start_append(stream, path, checkpoint).awaitTermination()
    return fields_with(normalize(tables.table(spark, path)), "ingestion_date")


def _two_polls(
    spark: SparkSession, raw: DataFrame, take: Callable[[str, str], None], backfill: bool = False
) -> None:
    """Open incidents first, then two of three again, revised and ended.

    Each poll is landed by all tasks; then ``take`` gets the landing area and the day.
    """
    landing = shared_folder(spark, "polls")
    still_open = raw.where(_id() % 3 != 0).withColumn("endDate", F.lit(""))
    # The older day lands last: a backfill, which must not undo the later poll.
    polls = [("2024-02-01", _revised(raw)), ("2024-01-31", still_open)]
    for day, poll in polls if backfill else reversed(polls):
        poll = poll.withColumn("ingestion_date", F.lit(day).cast("date"))
        responses = _responses(poll, "ingestion_date")
        responses.write.mode("append").partitionBy("ingestion_date").text(landing)
        take(landing, day)


def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    raw = as_text(incident_events(spark, folder)).withColumn(
        "linkId", (_id() + 2000000000).cast("string")
    )
    path, progress = shared_folder(spark, "upserted"), shared_folder(spark, "progress")

    def take(landing: str, day: str) -> None:
        stream = ingest.landed_stream(spark, landing, one_per_line=True)
        stream_merge(stream, path, progress).awaitTermination()

    _two_polls(spark, raw, take, backfill=True)
    return upsert.read_table(spark, path).drop("ingestion_timestamp")


def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    raw = as_text(incident_events(spark, folder)).withColumn("coordX", _id().cast("string"))
    path, progress = shared_folder(spark, "latest"), shared_folder(spark, "progress")

    def take(landing: str, day: str) -> None:
        stream = ingest.landed_stream(spark, landing, one_per_line=True)
        stream_rewrite_latest(stream, path, progress).awaitTermination()

    _two_polls(spark, raw, take, backfill=True)
    return upsert.read_table(spark, path, upsert.CENTRAL_SCHEMA).drop("createdAt")


def stream_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Records of 14, 15 and 6 values in streamed CSV, a micro-batch for each day."""
    landing, checkpoint = shared_folder(spark, "csv"), shared_folder(spark, "progress")
    path, refused = shared_folder(spark, "typed"), shared_folder(spark, "refused")
    raw = as_text(incident_events(spark, folder))
    for day, rest in (("2024-01-31", 0), ("2024-02-01", 1)):
        for part in _broken(raw.where(_id() % 2 == rest)):
            files.land_csv(part, landing, day, mode="append")
        stream = ingest.landed_stream(spark, landing, "csv")
        ingest.start_typed_append(stream, path, refused, checkpoint).awaitTermination()
    return _loaded_and_refused(tables.table(spark, path), tables.table(spark, refused))


def stream_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """The changes that three polls bring: open incidents, the same ones again, and those
    and the rest, of which some are revised."""
    raw = as_text(incident_events(spark, folder)).withColumn(
        "linkId", (_id() + 2000000000).cast("string")
    )
    landing, path = shared_folder(spark, "polls"), shared_folder(spark, "changes")
    progress = shared_folder(spark, "progress")
    again = (_id() % 2 == 0) | (_id() % 3 == 0)
    revised = F.when(again, F.concat_ws("/", "eventType", F.lit("변경"))).otherwise(F.col("eventType"))
    # What the polls say is made in one pass: 0 what the first two do, 1 what the last does.
    told = F.when(_id() % 3 != 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    last_says = F.when(F.col("told") == 1, revised).otherwise(F.col("eventType"))
    responses = _responses(raw.withColumn("told", F.explode(told)).withColumn("eventType", last_says), "told")
    said = shared_folder(spark, "said")
    responses.write.partitionBy("told").text(said)
    for day, told in (("2024-01-30", 0), ("2024-01-31", 0), ("2024-02-01", 1)):
        poll = spark.read.schema("value string, told int").text(said).where(F.col("told") == told)
        poll = poll.select("value", F.lit(day).cast("date").alias("ingestion_date"))
        poll.write.mode("append").partitionBy("ingestion_date").text(landing)
        stream = changed_records(ingest.landed_stream(spark, landing, one_per_line=True))
        ingest.start_append(stream, path, progress).awaitTermination()
    return fields_with(tables.table(spark, path), "ingestion_date")


def load_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    raw = as_text(incident_events(spark, folder)).withColumn("coordX", _id().cast("string"))
    landing, path = shared_folder(spark, "csv"), shared_folder(spark, "central")
    still_open = raw.where(_id() % 3 != 0).withColumn("endDate", F.lit(""))
    for day, poll in (("2024-01-31", still_open), ("2024-02-01", _revised(raw))):
        files.land_csv(fields_with(poll), landing, day, mode="append")
        loads.load_snapshot(spark, loads.day_folder(landing, day), path, stamp=_at(day))
    return upsert.read_table(spark, path, upsert.CENTRAL_SCHEMA).drop("createdAt")


def load_append(spark: SparkSession, folder: str) -> DataFrame:
    raw = dirty_text(incident_events(spark, folder))
    zone, path = shared_folder(spark, "zone"), shared_folder(spark, "append")
    for day, rest in (("2024-01-31", 0), ("2024-02-01", 1)):
        responses = shared_folder(spark, "json")
        _responses(raw.where(_id() % 2 == rest)).write.text(responses)
        loads.load_append(spark, responses, zone, path, day, one_per_line=True)
    return tables.table(spark, path)


def load_append_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """A day loaded twice and, after more files have come, twice again."""
    raw = dirty_text(incident_events(spark, folder))
    zone, path = shared_folder(spark, "zone"), shared_folder(spark, "append")
    for rest in (0, 1):
        polled = fields_with(raw.where(_id() % 2 == rest))
        files.land_csv(polled, zone, "2024-02-01", mode="append")
        for _ in range(2):
            loads.load_new_files(spark, loads.day_folder(zone, "2024-02-01"), path)
    return ledger.loaded(spark, path, TEXT_DATE_SCHEMA)


def load_merge(spark: SparkSession, folder: str) -> DataFrame:
    raw = as_text(incident_events(spark, folder)).withColumn(
        "linkId", (_id() + 2000000000).cast("string")
    )
    zone, path = shared_folder(spark, "zone"), shared_folder(spark, "merged")

    def take(landing: str, day: str) -> None:
        responses = loads.day_folder(landing, day)
        loads.load_merge(spark, responses, zone, path, day, one_per_line=True)

    _two_polls(spark, raw, take)
    return upsert.read_table(spark, path).drop("ingestion_timestamp")


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return models.report(models.build_models(incident_events(spark, folder), as_of=AS_OF))


def dq_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The tests' outcome, counted while the tested models are written as tables."""
    prefix = f"t{shared_folder(spark, 'tested').rsplit('-', 1)[1]}_"
    events = incident_events(spark, folder)
    return models.publish_models(events, as_of=AS_OF, prefix=prefix, strict=False)


def run_models(spark: SparkSession, folder: str) -> DataFrame:
    views = dict.fromkeys(models.MODELS, "view")
    events = incident_events(spark, folder)
    return models.run_models(events, as_of=AS_OF, kinds=views, strict=False)


def one_pass_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All values of the nine reports of the shared pass, one row per report row."""
    events, path = incident_events(spark, folder), shared_folder(spark, "rollup")
    return _report_values(reports_in_one_pass(events, path, as_of=AS_OF))


def _report_values(reports: dict[str, DataFrame]) -> DataFrame:
    measures = {
        "events": ("event_count", "total_cnt"),
        "mean": ("avg_duration_min", "average_duration_hours"),
        "least": ("min_duration_min",),
        "most": ("max_duration_min",),
        "share": ("percentage",),
    }
    kinds = {"events": "bigint", "least": "bigint", "most": "bigint"}
    parts = []
    for name, report in reports.items():
        named = {c: m for m, cs in measures.items() for c in cs if c in report.columns}
        keys = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in report.columns if c not in named]
        found = {m: F.col(c) for c, m in named.items()}
        parts.append(
            report.select(
                F.lit(name).alias("model"),
                F.concat_ws("|", *keys).alias("key"),
                *[found.get(m, F.lit(None)).cast(kinds.get(m, "double")).alias(m) for m in measures],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _three_batches(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Rollup and sketches after three batches of events, refreshed with each."""
    kept = {kind: shared_folder(spark, kind) for kind in ("events", "rollup", "sketches")}
    events = incident_events(spark, folder).select("event_id", *FIELDS)
    # The first two batches have days of their own, the third has all.
    early = F.col("startDate") < F.lit("2024-01-15").cast("timestamp_ntz")
    third = F.col("event_id") % 5 == 0
    for part in (early & ~third, ~early & ~third, third):
        batch = fields_with(events.where(F.coalesce(part, F.lit(True))))
        incremental.append_events(batch, kept["events"])
        incremental.refresh_rollup(
            batch, kept["events"], kept["rollup"], as_of=AS_OF, sketches=kept["sketches"]
        )
    return kept["rollup"], kept["sketches"]


def rollup_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The values of the nine reports, from a rollup kept current over three batches."""
    rollup, _ = _three_batches(spark, folder)
    return _report_values(incremental.current_reports(spark, rollup))


def events_by_road_type_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """The exact counts, and whether the estimates from day sketches lie within four
    standard errors of them."""
    _, sketches = _three_batches(spark, folder)
    estimated = incremental.events_by_road_type_estimated(tables.table(spark, sketches))
    exact = marts.events_by_road_type(incident_events(spark, folder))
    names = ["total_events", "total_roads", "active_days", "unique_locations"]
    joined = exact.join(estimated.withColumnsRenamed({n: f"_{n}" for n in names}), "road_type")
    near = [F.abs(F.col(f"_{n}") - F.col(n)) <= 4 * incremental.STANDARD_ERROR * F.col(n) for n in names]
    return joined.select("road_type", *names, *[c.alias(f"near_{n}") for n, c in zip(names, near)])


def compacted_days(spark: SparkSession, folder: str) -> DataFrame:
    """Polls appended to their days in many files, as CSV and Parquet, then compacted: the
    rows, and whether their day has fewer files than before."""
    csv, parquet = shared_folder(spark, "csv"), shared_folder(spark, "parquet")
    raw = as_text(incident_events(spark, folder))
    for poll in range(10):
        polled = fields_with(raw.where(_id() % 10 == poll))
        day = f"2024-01-{30 + poll % 2}"
        files.land_csv(polled, csv, day, mode="append")
        files.land_parquet(normalize(polled), parquet, day, mode="append")
    parts = []
    for kind, path in (("csv", csv), ("parquet", parquet)):
        before = spark.createDataFrame(compact.day_files(spark, path, kind).collect(), compact.FILES)
        compact.compact_days(spark, path, kind, max_files=4)
        rows = csv_files.csv_by_position(spark, path) if kind == "csv" else tables.table(spark, path)
        rows = normalize(rows) if kind == "csv" else rows
        after = compact.day_files(spark, path, kind).withColumnRenamed("files", "left")
        fewer = before.join(after, "day").select(
            F.to_date("day").alias("ingestion_date"), (F.col("left") < F.col("files")).alias("fewer")
        )
        kept = rows.join(fewer, "ingestion_date", "left")
        parts.append(kept.select(F.lit(kind).alias("kind"), "ingestion_date", "fewer", *FIELDS))
    return parts[0].unionByName(parts[1])


def table_switch(spark: SparkSession, folder: str) -> DataFrame:
    """What readers of a table see: of its first version, after a build that fails, from a
    reading begun before the next version and ended after it, and of that version."""
    name = f"summary_{shared_folder(spark, 'switch').rsplit('-', 1)[1]}"
    events = incident_events(spark, folder)
    first = publish(marts.event_type_summary(events.where(_id() % 3 != 0)), name)
    seen = {"first": first}
    count = F.when(F.col("event_count") >= 0, F.raise_error("fails").cast("bigint"))
    try:
        publish(first.withColumn("event_count", count), name)
    except PySparkException:
        seen["after_failure"] = spark.table(name)
    seen["begun_before"] = spark.table(name)
    publish(marts.event_type_summary(events), name)
    seen["next"] = spark.table(name)
    parts = [df.select(F.lit(when).alias("seen"), "*") for when, df in seen.items()]
    return reduce(DataFrame.unionByName, parts)


def insert_with_default(spark: SparkSession, folder: str) -> DataFrame:
    """Rows inserted without the column that has a declared default, and one with it."""
    name = f"events_{shared_folder(spark, 'default').rsplit('-', 1)[1]}"
    events = incident_events(spark, folder).select("event_id", *FIELDS)
    stamp = T.StructField("ingestion_timestamp", T.TimestampNTZType())
    schema = T.StructType([*events.schema.fields, stamp])
    default = f"timestamp_ntz'{AS_OF}'"
    create_table_if_absent(spark, name, schema, defaults={stamp.name: default})
    insert_by_name(events.where(_id() % 3 != 0), name)
    stamped = events.where(_id() % 3 == 0).withColumn(stamp.name, _ntz("2024-01-31 00:00:00"))
    insert_by_name(stamped, name)
    return spark.table(name)


def temporary_like(spark: SparkSession, folder: str) -> DataFrame:
    """An empty table of the events' shape, filled, read and dropped."""
    events, path = incident_events(spark, folder), shared_folder(spark, "like")
    name = f"events_like_{path.rsplit('-', 1)[1]}"
    materialize(empty_like(events), name, "table", path=path)
    files.append_load(events, path)
    spark.catalog.refreshTable(name)
    filled = spark.table(name)
    drop(spark, name)
    return tables.table(spark, path).select(*filled.columns)


def persistent_view(spark: SparkSession, folder: str) -> DataFrame:
    """A staging view in a schema of the catalog, over a stored table of events."""
    name = f"events_{shared_folder(spark, 'view').rsplit('-', 1)[1]}"
    stored = materialize(incident_events(spark, folder), name, "table", schema="analytics")
    columns = ", ".join(marts.stg_event_info(stored).columns)
    query = f"SELECT {columns} FROM analytics.{name}"
    return create_view(spark, f"stg_{name}", query, "analytics")


def materialized_table(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "table")
    name = f"event_type_summary_{path.rsplit('-', 1)[1]}"
    summary = marts.event_type_summary(incident_events(spark, folder))
    return materialize(summary, name, "table", path=path)


QUERIES: dict[str, Query] = {
    **{name: _mart(model.build) for name, model in models.MODELS.items()},
    "normalize_typed": normalize_typed,
    "load_rejects": load_rejects,
    "null_markers": null_markers,
    "stringify": stringify_all,
    "dedup_first": dedup_first,
    "dedup_latest": dedup_latest,
    "snapshot_rewrite": snapshot_rewrite,
    "snapshot_rewrite_table": snapshot_rewrite_table,
    "distinct_rows": distinct_rows,
    "merge_upsert": merge_upsert,
    "merge_table": merge_table,
    "merge_bucketed": merge_bucketed,
    "json_envelope": json_envelope,
    "json_envelope_files": json_envelope_files,
    "json_one_file": json_one_file,
    "csv_by_position": csv_by_position,
    "csv_by_name": csv_by_name,
    "csv_by_name_per_file": csv_by_name_per_file,
    "parquet_by_name": parquet_by_name,
    "zip_csv": zip_csv,
    "load_archives": load_archives,
    "load_archives_bad_rows": load_archives_bad_rows,
    "partition_scan": partition_scan,
    "append_load": append_load,
    "full_refresh": full_refresh,
    "stream_ingest": stream_ingest,
    "stream_upsert": stream_upsert,
    "stream_latest": stream_latest,
    "stream_csv_rejects": stream_csv_rejects,
    "stream_unchanged": stream_unchanged,
    "load_snapshot": load_snapshot,
    "load_snapshot_bad_rows": load_snapshot_bad_rows,
    "load_append": load_append,
    "load_append_rerun": load_append_rerun,
    "load_merge": load_merge,
    "dq_report": dq_report,
    "dq_observed": dq_observed,
    "run_models": run_models,
    "one_pass_reports": one_pass_reports,
    "rollup_incremental": rollup_incremental,
    "events_by_road_type_sketch": events_by_road_type_sketch,
    "compacted_days": compacted_days,
    "materialized_table": materialized_table,
    "table_switch": table_switch,
    "insert_with_default": insert_with_default,
    "temporary_like": temporary_like,
    "persistent_view": persistent_view,
    "hourly_event_heatmap_text": hourly_event_heatmap_text,
}

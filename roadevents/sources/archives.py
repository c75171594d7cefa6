"""CSV entries of zip archives: unpacked inside the tasks, parsed by Spark."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadevents.schema import FIELDS
from roadevents.sources.records import (
    bound_by_header,
    bound_by_position,
    first_record,
    listing,
    opened,
    text_records,
)

# Text of unpacked records that a task holds before it gives them to Spark.
_HELD_CHARS = 1 << 20
ENTRIES = "archive string, entry string, number long, size long"
RECORDS = "archive string, entry string, header string, record string"

Open = Callable[[str], BinaryIO]


def entries(spark: SparkSession, path: str, open_file: Open = opened) -> DataFrame:
    """archive, entry, number and unpacked size of the ``.csv`` entries of the ``.zip``
    files under ``path``. Of an archive only the directory at its end is read."""

    def directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("path").to_pylist():
                with open_file(archive) as file, zipfile.ZipFile(file) as unzipped:
                    found = [i for i in unzipped.infolist() if i.filename.endswith(".csv")]
                columns = [
                    pa.array([archive] * len(found), pa.string()),
                    pa.array([i.filename for i in found], pa.string()),
                    pa.array(range(len(found)), pa.int64()),
                    pa.array([i.file_size for i in found], pa.int64()),
                ]
                yield pa.record_batch(columns, names=["archive", "entry", "number", "size"])

    return listing(spark, path, "*.zip").select("path").mapInArrow(directories, ENTRIES)


def _read(
    found: DataFrame, encoding: str, open_file: Open, *, headers_only: bool = False
) -> DataFrame:
    def batch(archive: str, entry: str, header: str, held: list[str]) -> pa.RecordBatch:
        columns = [[archive] * len(held), [entry] * len(held), [header] * len(held), held]
        names = ["archive", "entry", "header", "record"]
        return pa.record_batch([pa.array(c, pa.string()) for c in columns], names=names)

    def unpack(unzipped: zipfile.ZipFile, archive: str, entry: str) -> Iterator[pa.RecordBatch]:
        with unzipped.open(entry) as binary:
            stream = io.TextIOWrapper(binary, encoding=encoding, newline="")
            header = first_record(stream)
            if headers_only:
                yield batch(archive, entry, header, [""])
                return
            held, size = [], 0
            for record in text_records(stream):
                held.append(record)
                size += len(record)
                if size > _HELD_CHARS:
                    yield batch(archive, entry, header, held)
                    held, size = [], 0
            if held:
                yield batch(archive, entry, header, held)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            # Entries of one archive follow one another.
            named: dict[str, list[str]] = {}
            for archive, entry in zip(*[rows.column(c).to_pylist() for c in ("archive", "entry")]):
                named.setdefault(archive, []).append(entry)
            for archive, names in named.items():
                with open_file(archive) as file, zipfile.ZipFile(file) as unzipped:
                    for entry in names:
                        yield from unpack(unzipped, archive, entry)

    return found.mapInArrow(read, RECORDS)


def zip_csv(
    spark: SparkSession,
    path: str,
    fields: Sequence[str] = FIELDS,
    *,
    by: str = "name",
    encoding: str = "utf-8",
    open_file: Open = opened,
) -> DataFrame:
    """Rows of every ``.csv`` entry of the ``.zip`` files under ``path``, with ``archive``
    and ``entry`` naming the origin.

    Entries are dealt to the tasks by archive and place, so a large archive is unpacked by
    many; each opens the archive as a seekable stream and holds about a megabyte of
    records, or one record. ``by`` binds columns by header ``"name"`` or by ``"position"``.
    By name, the distinct headers are learned first, from the first records alone. Rows
    with a wrong number of values are filled or cut to fit and have their text in
    ``_corrupt_record``. ``open_file`` opens a path of a store that Arrow does not know.
    """
    if by not in ("name", "position"):
        raise ValueError(f"by must be 'name' or 'position', not {by!r}")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = entries(spark, path, open_file).repartitionByRange(tasks, "archive", "number")
    whole = _read(found, encoding, open_file)
    if by == "position":
        return bound_by_position(whole, fields, "archive", "entry")
    first = _read(found, encoding, open_file, headers_only=True).select("header").distinct()
    headers = [r["header"] for r in first.collect()]
    return bound_by_header(whole, headers, fields, "archive", "entry")

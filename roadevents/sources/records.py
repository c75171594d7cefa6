"""Files opened inside the tasks: their listing, their first record, their layouts."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from functools import lru_cache
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.operators.normalize import CORRUPT

# An absent value is null and a quoted empty one is empty text. Spark only keeps the
# two apart if the null marker is text that does not occur.
VALUE_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "\u0001", "emptyValue": ""}
# What one read of an opened file fetches.
BLOCK_BYTES = 1 << 18
# Headers that a worker keeps.
_KEPT_HEADERS = 4096


def listing(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """path, modificationTime and length of the files under ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return files.option("recursiveFileLookup", True).load(path).drop("content")


def opened(path: str) -> io.BufferedReader:
    """A file as a seekable stream, by its path or URI. Blocks are fetched as they are read."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "file", path
    if scheme == "file":
        file = fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    else:
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        store, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/@:,=')}")
        file = store.open_input_file(name)
    return io.BufferedReader(file, BLOCK_BYTES)


def text_records(stream: io.TextIOBase) -> Iterator[str]:
    """The stream's records: lines, joined while a quoted value is open."""
    parts, quotes = [], 0
    for line in stream:
        parts.append(line)
        quotes += line.count('"')
        if quotes % 2 == 0:
            record = "".join(parts).rstrip("\r\n")
            parts, quotes = [], 0
            if record:
                yield record
    if parts:
        yield "".join(parts).rstrip("\r\n")


def first_record(stream: io.TextIOBase) -> str:
    return next(text_records(stream), "").lstrip("﻿")


@lru_cache(_KEPT_HEADERS)
def _header(path: str, encoding: str) -> str:
    with opened(path) as file:
        return first_record(io.TextIOWrapper(file, encoding=encoding, newline=""))


def header_of(path: Column, encoding: str = "utf-8", *, escaped: bool = False) -> Column:
    """The header of the file that a row is from; a task reads the file's first block once.

    ``escaped`` is for paths as ``_metadata.file_path`` gives them.
    """

    @F.pandas_udf("string")
    def headers(paths: pd.Series) -> pd.Series:
        names = {p: _header(unquote(p) if escaped else p, encoding) for p in paths.unique()}
        return paths.map(names)

    return headers(path)


def header_names(line: str) -> tuple[str, ...]:
    return tuple(h.strip() for h in next(csv.reader(io.StringIO(line.rstrip("\r\n"))), []))


def text_schema(names: Sequence[str]) -> T.StructType:
    """Text columns, and one for records with a wrong number of values."""
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in text_schema(names))


def _parsed(record: Column, names: Sequence[str]) -> Column:
    options = {**VALUE_OPTIONS, "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    # A record may hold any line end inside quotes, so none ends it.
    options["lineSep"] = "\u0001"
    return F.from_csv(record, _ddl(names), options)


def bound_by_position(found: DataFrame, fields: Sequence[str], *extra: str) -> DataFrame:
    """``record`` text as ``fields`` in order, ``_corrupt_record`` and ``extra`` columns."""
    flat = found.select(_parsed(F.col("record"), fields).alias("row"), *extra)
    return flat.select("row.*", *extra)


def bound_by_header(
    found: DataFrame, headers: Sequence[str], fields: Sequence[str], *extra: str
) -> DataFrame:
    """``record`` text as the ``fields`` that the row's ``header`` names, in one pass.

    ``headers`` are the distinct headers. Names are found without regard to case; missing
    ones are null, others dropped. A record with a wrong number of values is filled or cut
    and has its text in ``_corrupt_record``.
    """
    # The parsed records of a layout are null in rows of the others.
    parsed, bound = {}, {f: [] for f in (*fields, CORRUPT)}
    for i, header in enumerate(sorted(headers)):
        names = [n.lower() for n in header_names(header)]
        parsed[f"layout_{i}"] = F.when(F.col("header") == header, _parsed(F.col("record"), names))
        for f in bound:
            if f.lower() in names or f == CORRUPT:
                bound[f].append(F.col(f"layout_{i}").getField(f if f == CORRUPT else f.lower()))
    none = F.lit(None).cast("string")
    flat = found
    if parsed:
        # Generated, so that nothing above is pushed into copies of the parsing.
        step = F.struct(*[value.alias(name) for name, value in parsed.items()])
        flat = found.select("*", F.inline(F.array(step)))
    return flat.select(*[F.coalesce(*bound[f], none).alias(f) for f in bound], *extra)

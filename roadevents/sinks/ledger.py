"""Loads that take each file once.

Beside a table stands its ledger: path, size and modification time of every file that a
load has taken. A load lists its source, takes the files that the ledger does not hold,
writes their rows to a folder of its own, and last moves its page into the ledger. Only
rows of loads in the ledger are read. A load that fails in between therefore adds nothing,
and when it is run again it writes the same folder.

A file that was replaced under its name has another size or time and is taken again. One
load of a table runs at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.session import children, move, path_has_files, remove
from roadevents.sources.records import listing

LOAD = "load"
ENTRY = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)
FILE = tuple(ENTRY.names)

Build = Callable[[list[str]], "DataFrame | Mapping[str, DataFrame]"]


def ledger_of(table: str) -> str:
    return f"{table.rstrip('/')}-ledger"


def entries(spark: SparkSession, table: str) -> DataFrame:
    """The files that loads of the table have taken, with the ``load`` that took them."""
    schema = T.StructType([*ENTRY.fields, T.StructField(LOAD, T.StringType())])
    ledger = ledger_of(table)
    if not path_has_files(spark, ledger):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger)


def pending(spark: SparkSession, source: str, table: str, glob: str = "*.csv") -> DataFrame:
    """The files under ``source`` that no load of the table has taken as they are now."""
    found = listing(spark, source, glob).select(*FILE)
    return found.join(entries(spark, table).select(*FILE), list(FILE), "left_anti")


def _literal(path: str) -> str:
    """The path as a pattern that only it matches; readers take patterns."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def load_once(
    spark: SparkSession, source: str, table: str, build: Build, *, glob: str = "*.csv"
) -> int:
    """Adds the rows of the files that are new since the last load; how many files.

    ``build`` makes the table's rows of a list of paths, or the rows of several tables by
    their folders, which all belong to the load. The driver holds the new files' paths, as
    Spark's own reader does, and never those taken before.
    """
    page = f"{ledger_of(table)}-pages/{uuid.uuid4().hex}"
    # The list is written down first: what is read and what is entered are the same files.
    pending(spark, source, table, glob).write.parquet(page)
    try:
        taken = spark.read.schema(ENTRY).parquet(page)
        paths = [_literal(r["path"]) for r in taken.select("path").orderBy("path").collect()]
        if not paths:
            return 0
        row = F.xxhash64(*FILE)
        # The same files give the same name, so a repeated load replaces its own folder.
        name = taken.agg(F.bit_xor(row), F.count("*"), F.sum(F.hash(*FILE))).first()
        load = "-".join(f"{value & (1 << 64) - 1:x}" for value in name)
        built = build(paths)
        for target, rows in (built if isinstance(built, Mapping) else {table: built}).items():
            rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{LOAD}={load}")
        if not move(spark, page, f"{ledger_of(table)}/{LOAD}={load}"):
            raise OSError(f"{page} is gone")
        return len(paths)
    finally:
        remove(spark, page)


def loaded(
    spark: SparkSession, target: str, schema: T.StructType, table: str | None = None
) -> DataFrame:
    """The rows that finished loads have added to ``target``, a folder that loads of
    ``table`` (default: itself) write. Folders of other loads are not read."""
    names = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    if not path_has_files(spark, target):
        return spark.createDataFrame([], schema)
    # As values, a name for each load, so that other folders are left out of the scan.
    finished = F.col(LOAD).isin(_finished(spark, table or target))
    return spark.read.schema(names).parquet(target).where(finished).drop(LOAD)


def _finished(spark: SparkSession, table: str) -> list[str]:
    ledger = children(spark, ledger_of(table))
    return [name.removeprefix(f"{LOAD}=") for name in ledger if name.startswith(f"{LOAD}=")]


def drop_unfinished(spark: SparkSession, target: str, table: str | None = None) -> list[str]:
    """Removes what failed loads have left in ``target``; the names of these loads."""
    finished = {f"{LOAD}={name}" for name in _finished(spark, table or target)}
    left = [c for c in children(spark, target) if c.startswith(f"{LOAD}=") and c not in finished]
    for name in left:
        remove(spark, f"{target.rstrip('/')}/{name}")
    return left

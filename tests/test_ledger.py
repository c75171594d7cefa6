"""Loads that take each file once, also when one fails half-way."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.plans import loads
from roadevents.schema import FIELDS, TEXT_DATE_SCHEMA
from roadevents.sinks import ledger
from roadevents.sources.csv_files import csv_by_position

HEADER = ",".join(FIELDS)


def write(folder, name, *types, end=""):
    folder.mkdir(parents=True, exist_ok=True)
    rows = "".join(t + "," * (len(FIELDS) - 1) + end + "\n" for t in types)
    (folder / name).write_text(f"{HEADER}\n{rows}")


def types(spark, table, source=None):
    schema = T.StructType([TEXT_DATE_SCHEMA["type"]])
    return sorted(r.type for r in ledger.loaded(spark, table, schema, source).collect())


def test_each_file_once(spark, tmp_path):
    zone, table = tmp_path / "zone", str(tmp_path / "table")
    write(zone / "day=1", "a.csv", "a")
    write(zone / "day=1", "odd [1]{x}*.csv", "odd")
    (zone / "day=1" / "notes.txt").write_text("no")
    load = lambda: loads.load_new_files(spark, str(zone), table)
    assert (load(), load()) == (2, 0) and types(spark, table) == ["a", "odd"]
    write(zone / "day=2", "a.csv", "b", "c")
    assert (load(), load()) == (1, 0) and types(spark, table) == ["a", "b", "c", "odd"]
    # Replaced under its name: taken again, as it is now.
    write(zone / "day=1", "a.csv", "aa")
    os.utime(zone / "day=1" / "a.csv", (1, 1))
    assert (load(), load()) == (1, 0) and types(spark, table) == ["a", "aa", "b", "c", "odd"]
    assert ledger.entries(spark, table).count() == 4


def test_a_load_that_fails_adds_nothing(spark, tmp_path):
    zone, table, other = tmp_path / "zone", str(tmp_path / "table"), str(tmp_path / "other")
    write(zone, "a.csv", "a")

    def build(paths, fails=False):
        rows = csv_by_position(spark, paths).select(*TEXT_DATE_SCHEMA.names)
        bad = rows.withColumn("type", F.raise_error("fails").cast("string"))
        return {other: rows, table: bad if fails else rows}

    with pytest.raises(PySparkException, match="fails"):
        ledger.load_once(spark, str(zone), table, lambda paths: build(paths, True))
    # One table has the rows already, but its load is not in the ledger.
    assert types(spark, other, table) == types(spark, table) == []
    assert ledger.pending(spark, str(zone), table).count() == 1
    assert len(ledger.drop_unfinished(spark, other, table)) == 1
    assert ledger.load_once(spark, str(zone), table, build) == 1
    assert types(spark, other, table) == types(spark, table) == ["a"]
    assert ledger.drop_unfinished(spark, other, table) == []


def test_a_repeated_load_replaces_what_the_failed_one_wrote(spark, tmp_path):
    zone, table = tmp_path / "zone", str(tmp_path / "table")
    write(zone, "a.csv", "a", "b")
    rows = lambda paths: csv_by_position(spark, paths).select(*TEXT_DATE_SCHEMA.names)
    target = {}

    def interrupted(paths):
        built = rows(paths)
        target["written"] = built
        return {table: built, f"{table}-x": built.where(F.raise_error("fails").cast("boolean"))}

    with pytest.raises(PySparkException):
        ledger.load_once(spark, str(zone), table, interrupted)
    assert len(os.listdir(table)) == 1
    assert ledger.load_once(spark, str(zone), table, rows) == 1
    assert len([n for n in os.listdir(table) if n.startswith("load=")]) == 1
    assert types(spark, table) == ["a", "b"]


def test_rejects_and_headers_of_their_own(spark, tmp_path):
    zone, table, refused = tmp_path / "zone", str(tmp_path / "table"), str(tmp_path / "refused")
    write(zone, "a.csv", "a", end="")
    (zone / "b.csv").write_text('LINKID,type\nx1,"b\nb"\n7,c\n8,d,surplus\n')
    assert loads.load_new_files(spark, str(zone), table, rejects_table=refused) == 2
    assert types(spark, table) == ["a", "c"]
    bad = spark.read.parquet(refused)
    assert sorted((r.type, r.reject_reason) for r in bad.collect()) == [("b\nb", "linkId"), ("d", "column_count")]


def test_an_empty_source(spark, tmp_path):
    (tmp_path / "zone").mkdir()
    table = str(tmp_path / "table")
    assert loads.load_new_files(spark, str(tmp_path / "zone"), table) == 0
    assert types(spark, table) == []

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadevents.operators.normalize import CORRUPT
from roadevents.schema import CENTRAL_SCHEMA, EVENT_SCHEMA, MERGE_SCHEMA
from roadevents.sinks import bucketed, files, tables, upsert
from roadevents.sources import csv_files

T0, T1 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 2, 8)


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def test_landing_a_day_again_replaces_only_that_day(spark, path):
    one, two = spark.sql("select 'a' v"), spark.sql("select 'b' v")
    for write, read in ((files.land_csv, "csv"), (files.land_parquet, "parquet")):
        folder = f"{path}/{read}"
        write(one, folder, "2024-01-01")
        write(one, folder, "2024-01-02")
        write(two, folder, "2024-01-02")
        rows = spark.read.option("header", True).format(read).load(folder).collect()
        assert sorted((r.v, r.ingestion_date.day) for r in rows) == [("a", 1), ("b", 2)]
        write(two, folder, "2024-01-02", mode="append")
        assert spark.read.format(read).option("header", True).load(folder).count() == 3
    with pytest.raises(ValueError):
        files.land_csv(one, path, "2024-01-01", mode="ignore")


def test_csv_round_trip(spark, raw, path):
    rows = [
        {"type": ' "x"', "message": "a,\nb "}, {"type": "", "message": None}, {"message": "\\"},
    ]
    frame = raw(*rows)
    files.land_csv(frame, path, "2024-01-01")
    back = csv_files.csv_by_position(spark, path).drop("ingestion_date", CORRUPT)
    assert sorted(back.collect(), key=str) == sorted(frame.collect(), key=str)


def test_land_deduplicated(spark, raw, path):
    frame = raw({"startDate": "s", "linkId": "1", "message": "a"}, {"startDate": "s", "linkId": "1"})
    frame = frame.withColumn("seq", F.when(F.col("message") == "a", 1).otherwise(0))
    files.land_deduplicated(frame, path, "2024-01-01")
    row = spark.read.parquet(path).first()
    assert row.message is None and row.unique_id == "s_1"


def test_create_append_refresh(spark, path):
    row = spark.sql("select 1 a")
    files.create_if_absent(spark, path, row.schema)
    assert spark.read.parquet(path).count() == 0
    files.append_load(row, path)
    files.append_load(row, path)
    files.create_if_absent(spark, path, row.schema)
    assert spark.read.parquet(path).count() == 2
    files.full_refresh(row, path)
    assert spark.read.parquet(path).count() == 1


def test_declared_table_fills_its_default(spark):
    tables.create_table_if_absent(
        spark, "declared", MERGE_SCHEMA, defaults={"ingestion_timestamp": "localtimestamp()"}
    )
    tables.create_table_if_absent(spark, "declared", MERGE_SCHEMA)
    spark.sql("insert into declared (type, linkId) values ('국도', 1)")
    row = spark.table("declared").first()
    assert row.type == "국도" and row.ingestion_timestamp is not None
    assert spark.table("declared").schema.names == MERGE_SCHEMA.names
    tables.drop(spark, "declared")
    assert not spark.catalog.tableExists("declared")


def test_materialize(spark, path):
    frame = spark.range(3)
    assert tables.materialize(frame, "as_view").count() == 3
    assert tables.materialize(frame, "as_table", "table", path=path).count() == 3
    assert spark.read.parquet(path).count() == 3
    assert tables.empty_like(frame).schema == frame.schema
    tables.drop(spark, "as_view")
    tables.drop(spark, "as_table")
    with pytest.raises(ValueError):
        tables.materialize(frame, "x", "index")


def data_files(path, day):
    return sorted(p.name for p in Path(path, f"start_day={day}").glob("*.parquet"))


def test_merge_touches_only_its_days(spark, events, path):
    schema = T.StructType([*EVENT_SCHEMA.fields, MERGE_SCHEMA["ingestion_timestamp"]])
    events_at = lambda *rows: events(*rows)
    first = events_at(
        {"startDate": T0, "linkId": 1, "message": "a"},
        {"startDate": T1, "linkId": 2, "message": "b"},
        {"startDate": None, "linkId": 3, "message": "c"},
    )
    upsert.merge_into(first, path, stamp=stamp("2024-01-03"), schema=schema)
    before = data_files(path, "2024-01-01")
    batch = events_at(
        {"startDate": T1, "linkId": 2, "message": "B", "endDate": T1},
        {"startDate": T1, "linkId": 9, "message": "new"},
        {"startDate": None, "linkId": 3, "message": "again"},
    )
    upsert.merge_into(batch, path, stamp=stamp("2024-01-04"), schema=schema)
    assert data_files(path, "2024-01-01") == before
    table = upsert.read_table(spark, path, schema)
    assert table.schema.names == schema.names
    assert {r.message for r in table.collect()} == {"a", "B", "new", "c", "again"}
    once = sorted(map(str, table.collect()))
    complete = batch.where("startDate is not null")
    upsert.merge_into(complete, path, stamp=stamp("2024-01-04"), schema=schema)
    assert sorted(map(str, upsert.read_table(spark, path, schema).collect())) == once


def test_merge_of_text_dates(spark, events, path):
    at = lambda start, link, text: events(
        {"startDate": start, "linkId": link, "message": text}, schema=MERGE_SCHEMA
    ).drop("ingestion_timestamp")
    upsert.merge_into(at("20240101080000", 1, "a"), path)
    upsert.merge_into(at("not a date", 1, "x"), path)
    upsert.merge_into(at("not a date", 1, "y"), path)
    upsert.merge_into(at("20240101080000", 2, "b"), path)
    assert {r.message for r in upsert.read_table(spark, path).collect()} == {"a", "b", "y"}


def test_rewrite_latest(spark, events, path):
    at = lambda text, day, **more: events(
        {"startDate": T0, "coordX": 1.0, "message": text, **more}, schema=CENTRAL_SCHEMA
    ).withColumn("createdAt", F.lit(day).cast("timestamp"))
    upsert.rewrite_latest(at("old", "2024-01-02"), path)
    upsert.rewrite_latest(at("new", "2024-01-03"), path)
    upsert.rewrite_latest(at("older", "2024-01-01"), path)
    upsert.rewrite_latest(at("other", "2024-01-01", coordY=2.0), path)
    upsert.rewrite_latest(at("late", "2024-01-01", startDate=T1), path)
    table = upsert.read_table(spark, path, CENTRAL_SCHEMA)
    assert {r.message for r in table.collect()} == {"new", "other", "late"}


def test_many_days_touch_only_their_folders(spark, path):
    days = spark.range(4200).selectExpr(
        "cast(date_add(date'2010-01-01', cast(id as int)) as timestamp_ntz) startDate",
        "id linkId",
        "'a' message",
    )
    upsert.merge_into(days, path, schema=days.schema)
    before = data_files(path, "2010-01-03")
    batch = days.where("linkId <> 2").withColumn("message", F.lit("b"))
    upsert.merge_into(batch, path, schema=days.schema)
    assert len(before) == 1 and data_files(path, "2010-01-03") == before
    counts = upsert.read_table(spark, path, days.schema).groupBy("message").count().collect()
    assert {(r["message"], r["count"]) for r in counts} == {("a", 1), ("b", 4199)}


def test_a_refresh_that_fails_keeps_the_table(spark, path):
    files.full_refresh(spark.sql("select 1 a"), path)
    broken = spark.range(4).selectExpr("if(id = 3, raise_error('broken'), 2) a")
    with pytest.raises(Exception, match="broken"):
        files.full_refresh(broken.select(F.col("a").cast("int")), path)
    assert [r.a for r in spark.read.parquet(path).collect()] == [1]
    files.full_refresh(spark.read.parquet(path).selectExpr("a + 1 AS a"), path)
    assert [r.a for r in spark.read.parquet(path).collect()] == [2]
    assert not list(Path(path).parent.glob("*-new-*")) + list(Path(path).parent.glob("*-old-*"))


def test_a_table_model_that_fails_keeps_the_table(spark, path):
    tables.materialize(spark.range(2), "kept", "table", path=path)
    broken = spark.range(4).selectExpr("if(id = 3, raise_error('broken'), id) id")
    with pytest.raises(Exception, match="broken"):
        tables.materialize(broken.select(F.col("id").cast("long")), "kept", "table", path=path)
    assert spark.table("kept").count() == 2
    tables.materialize(spark.range(5), "kept", "table", path=path)
    assert spark.table("kept").count() == 5
    tables.drop(spark, "kept")


def test_a_day_is_one_file_however_many_tasks_write(spark, path):
    frame = spark.range(0, 3000, 1, 8).selectExpr(
        "date_add(date'2024-01-01', cast(id % 30 as int)) ingestion_date", "id"
    )
    files.land_parquet(frame, path)
    written = list(Path(path).glob("*/*.parquet"))
    assert len({f.parent for f in written}) == len(written) == 30


def test_persistent_view_follows_its_table(spark, path):
    spark.sql("create database if not exists reports")
    tables.materialize(spark.range(3), "numbers", "table", path=path, schema="reports")
    view = tables.create_view(spark, "small", "select id from reports.numbers where id < 9", "reports")
    assert view.count() == 3
    spark.table("reports.numbers")
    files.append_load(spark.range(3), path)
    spark.catalog.refreshTable("reports.numbers")
    assert spark.table("reports.small").count() == 6
    tables.drop(spark, "reports.small")
    tables.drop(spark, "reports.numbers")
    assert not spark.catalog.tableExists("reports.small")


def test_stored_tables_need_the_start_in_the_key(events, path):
    with pytest.raises(ValueError, match="startDate"):
        upsert.merge_into(events({"linkId": 1}), path, keys=["linkId"], schema=EVENT_SCHEMA)


def test_duplicate_batch_keys_leave_the_table_alone(spark, events, path):
    row = {"startDate": T0, "linkId": 1}
    upsert.merge_into(events(row), path, schema=EVENT_SCHEMA)
    with pytest.raises(ValueError, match="several rows"):
        upsert.merge_into(events(row, row), path, schema=EVENT_SCHEMA)
    assert upsert.read_table(spark, path, EVENT_SCHEMA).count() == 1


def test_a_day_with_most_rows_is_written_by_several_tasks(spark, path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        frame = spark.range(0, 60000, 1, 4).selectExpr(
            "cast(if(id % 3 = 0, '2024-01-02', '2024-01-01') as timestamp_ntz) startDate",
            "id linkId",
            "string(uuid()) message",
        )
        schema = frame.schema
        upsert.merge_into(frame, path, schema=schema)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(data_files(path, "2024-01-01")) > 1
    assert upsert.read_table(spark, path, schema).count() == 60000


def versions(spark, name):
    *schema, table = name.split(".")
    location = spark.catalog.getDatabase(*(schema or ["default"])).locationUri
    return sorted(p.name for p in Path(location.removeprefix("file:"), f"{table}-versions").glob("*"))


def test_published_versions(spark):
    begun = tables.publish(spark.range(2), "published")
    broken = spark.range(4).selectExpr("if(id = 3, raise_error('broken'), id) id")
    with pytest.raises(Exception, match="broken"):
        tables.publish(broken.select(F.col("id").cast("long")), "published")
    assert spark.table("published").count() == 2 and len(versions(spark, "published")) == 1
    other = spark.newSession()
    begun_elsewhere = other.table("published")
    tables.publish(spark.range(5), "published")
    assert (begun.count(), begun_elsewhere.count()) == (2, 2)
    assert (spark.table("published").count(), other.newSession().table("published").count()) == (5, 5)
    # A version may be made of the one before; the last two stay.
    tables.publish(spark.table("published").selectExpr("id + 1 AS id"), "published")
    assert rows_of(spark.table("published")) == [1, 2, 3, 4, 5]
    assert len(versions(spark, "published")) == 2
    tables.drop(spark, "published")
    assert versions(spark, "published") == [] and not spark.catalog.tableExists("published")


def rows_of(df):
    return sorted(r.id for r in df.collect())


def test_published_columns(spark):
    tables.publish(spark.range(2), "columns")
    tables.publish(spark.range(1).selectExpr("id", "'x' AS more"), "columns")
    assert [tuple(r) for r in spark.table("columns").collect()] == [(0, "x")]
    tables.publish(spark.range(3).selectExpr("string(id) AS id"), "columns")
    assert rows_of(spark.table("columns")) == ["0", "1", "2"]
    tables.drop(spark, "columns")


def test_published_in_a_schema(spark):
    assert tables.materialize(spark.range(2), "model", "table", schema="marts_x").count() == 2
    assert len(versions(spark, "marts_x.model")) == 1
    tables.drop(spark, "marts_x.model")


def test_inserts_by_name(spark):
    schema = T.StructType().add("a", "long").add("b", "string").add("c", "long")
    tables.create_table_if_absent(spark, "by_name", schema, defaults={"c": "7"})
    tables.insert_by_name(spark.sql("select 'x' AS b, 1L AS a"), "by_name")
    tables.insert_by_name(spark.sql("select 2L AS c, 3L AS a"), "by_name")
    assert {tuple(r) for r in spark.table("by_name").collect()} == {(1, "x", 7), (3, None, 2)}
    tables.drop(spark, "by_name")


def test_bucketed_merge_equals_the_plain_one(spark, events, path):
    first = [{"startDate": f"2024010{d}080000", "linkId": i, "message": "a"} for d in (1, 2, 3) for i in range(9)]
    first += [{"startDate": None, "linkId": 1, "message": "n"}, {"startDate": "20240101080000", "message": "k"}]
    again = [{"startDate": f"2024010{d}080000", "linkId": i, "message": "b"} for d in (2, 4) for i in (3, 30)]
    again += [{"startDate": None, "linkId": 1, "message": "n"}]
    bucketed.create_bucketed(spark, "bucketed_merge", buckets=4)
    bucketed.create_bucketed(spark, "bucketed_merge")
    for batch in (first, again):
        df = events(*batch, schema=MERGE_SCHEMA).drop("ingestion_timestamp")
        upsert.merge_into(df, path, stamp=stamp("2024-01-01 00:00:00"))
        bucketed.merge_bucketed(df, "bucketed_merge", stamp=stamp("2024-01-01 00:00:00"))
    plain = upsert.read_table(spark, path)
    got = spark.table("bucketed_merge").select(*plain.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() == 33
    doubled = events(*[again[0]] * 2, schema=MERGE_SCHEMA)
    with pytest.raises(ValueError, match="several rows"):
        bucketed.merge_bucketed(doubled, "bucketed_merge")
    with pytest.raises(ValueError, match="startDate"):
        bucketed.merge_bucketed(doubled, "bucketed_merge", ["linkId"])
    tables.drop(spark, "bucketed_merge")


def test_a_landed_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROW_GROUP_BYTES", 4096)
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("message"))
    files.land_parquet(rows, str(tmp_path / "zone"), "2024-01-01")
    landed = list((tmp_path / "zone").rglob("*.parquet"))
    assert len(landed) == 1 and pq.ParquetFile(landed[0]).num_row_groups > 3

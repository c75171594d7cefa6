import json
import zipfile

import pytest
from pyspark.sql import functions as F

from roadevents.plans import loads
from roadevents.schema import CENTRAL_SCHEMA, FIELDS
from roadevents.sinks import upsert
from roadevents.sources.csv_files import csv_by_position

DAY = "2024-01-01"


@pytest.fixture
def respond(tmp_path):
    def write(name, *items):
        folder = tmp_path / "responses" / name
        folder.mkdir(parents=True)
        (folder / "poll.json").write_text(json.dumps({"body": {"items": items}}))
        return str(folder)

    return write


def item(link="1", start="20240101080000", **more):
    return {"startDate": start, "linkId": link, **more}


def values(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_merge_load(spark, respond, tmp_path, path):
    zone, bad = str(tmp_path / "zone"), str(tmp_path / "bad")
    first = respond("a", item(message="x"), item(message="y"), item("2", message="z"), item("L"))
    loads.load_merge(spark, first, zone, path, DAY, rejects_table=bad)
    assert values(upsert.read_table(spark, path), "linkId", "message") == [(1, "x"), (2, "z")]
    assert values(spark.read.parquet(bad), "linkId", "reject_reason") == [("L", "linkId")]
    again = respond("b", item(message="x", endDate="20240101090000"), item(None, message="n"))
    loads.load_merge(spark, again, zone, path, DAY)
    assert values(upsert.read_table(spark, path), "linkId", "message", "endDate") == [
        (1, "x", "20240101090000"),
        (2, "z", None),
        (None, "n", None),
    ]
    day = loads.day_folder(zone, DAY)
    assert spark.read.option("pathGlobFilter", "*.parquet").parquet(day).count() == 2
    assert csv_by_position(spark, day).count() == 2


def test_append_load_keeps_every_poll(spark, respond, tmp_path, path):
    zone, bad = str(tmp_path / "zone"), str(tmp_path / "bad")
    responses = respond("a", item(type="-"), item("abc"))
    for _ in range(2):
        loads.load_append(spark, responses, zone, path, DAY, rejects_table=bad)
    table = spark.read.parquet(path)
    assert values(table, "type", "linkId") == [(None, 1)] * 2
    assert spark.read.parquet(bad).count() == 2
    assert csv_by_position(spark, zone).count() == 2


def test_empty_responses_are_refused(spark, respond, tmp_path, path):
    with pytest.raises(ValueError, match="no events"):
        loads.load_append(spark, respond("a"), str(tmp_path / "zone"), path, DAY)
    with pytest.raises(ValueError, match="no events"):
        loads.load_merge(spark, respond("b"), str(tmp_path / "zone"), path, DAY)


def test_snapshot_load_fails_before_the_table_changes(spark, tmp_path, path):
    def poll(name, start, message):
        row = {"startDate": start, "coordX": "1", "coordY": "-", "message": message}
        text = ",".join(row.get(f, "") for f in FIELDS)
        (tmp_path / name).write_text(f"{','.join(FIELDS)}\n{text}\n")
        return str(tmp_path / name)

    for name, message in (("a.csv", "old"), ("b.csv", "new")):
        loads.load_snapshot(spark, poll(name, "20240101080000", message), path)
    table = upsert.read_table(spark, path, CENTRAL_SCHEMA)
    assert values(table, "message", "coordY") == [("new", None)]
    with pytest.raises(Exception, match="bad record"):
        loads.load_snapshot(spark, poll("c.csv", "yesterday", "bad"), path)
    assert values(upsert.read_table(spark, path, CENTRAL_SCHEMA), "message") == [("new",)]


def test_refresh_and_archives(spark, tmp_path, path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("one.csv", "linkId,type\n1,국도\n")
    zone = str(tmp_path / "zone")
    loads.land_archives(spark, str(tmp_path / "a.zip"), zone, DAY)
    for _ in range(2):
        loads.refresh_raw(spark, zone, path)
    table = spark.read.parquet(path)
    assert values(table, "type", "linkId") == [("국도", "1")]
    assert table.columns == list(FIELDS) and {t for _, t in table.dtypes} == {"string"}
    assert table.where(F.col("message").isNotNull()).count() == 0


def test_spellings_of_one_key_are_one_key(spark, respond, tmp_path, path):
    zone = str(tmp_path / "zone")
    first = respond("a", item("110.0", message="b"), item("110", message="a"), item("7", message="c"))
    loads.load_merge(spark, first, zone, path, DAY)
    loads.load_merge(spark, respond("b", item("110.00", message="d")), zone, path, DAY)
    assert values(upsert.read_table(spark, path), "linkId", "message") == [(110, "d"), (7, "c")]


def test_plainly_spelled_keys_are_not_ranked_again(spark, respond, tmp_path, path, monkeypatch):
    ranked, dedup_first = [], loads.dedup_first
    monkeypatch.setattr(loads, "dedup_first", lambda *a: ranked.append(1) or dedup_first(*a))
    zone, links = str(tmp_path / "zone"), ("7", "0", "-3", None, "", "-", "nan", "L", "70", "7")
    rows = [item(x, message=str(n)) for n, x in enumerate(links)]
    loads.load_merge(spark, respond("a", *rows[:7], *rows[8:]), zone, path, DAY)
    assert not ranked
    expected = [(-3, "2"), (0, "1"), (7, "0"), (70, "8"), *[(None, str(n)) for n in (3, 4, 5, 6)]]
    assert values(upsert.read_table(spark, path), "linkId", "message") == expected
    for n, odd in enumerate(("7\n", " 7", "07", "+7", "7.", "7e0", "6.9")):
        loads.load_merge(spark, respond(f"b{n}", item(odd, message="x"), item("7", message="y")), zone, path, DAY)
        assert len(ranked) == n + 1
        said = values(upsert.read_table(spark, path).where("linkId = 7"), "message")
        assert said == [("x" if odd < "7" else "y",)]


def test_a_table_that_is_not_there_runs_no_task(spark, path):
    empty = upsert.read_table(spark, path)
    plan = empty._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "RDD" not in plan
    assert empty.columns == upsert.MERGE_SCHEMA.names and empty.count() == 0


def test_loads_fail_on_a_wrong_number_of_values(spark, tmp_path, path):
    header = ",".join(FIELDS)
    (tmp_path / "good.csv").write_text(f"{header}\n{',' * 13}\n")
    (tmp_path / "more.csv").write_text(f"{header}\n{',' * 14}\n")
    (tmp_path / "less.csv").write_text(f"{header}\n{',' * 5}\n")
    loads.refresh_raw(spark, str(tmp_path / "good.csv"), path)
    for bad in ("more.csv", "less.csv"):
        with pytest.raises(Exception, match="wrong number of values"):
            loads.refresh_raw(spark, str(tmp_path / bad), path)
        with pytest.raises(Exception, match="column_count"):
            loads.load_snapshot(spark, str(tmp_path / bad), path + "-central")
    assert spark.read.parquet(path).count() == 1


def test_archives_with_wrong_numbers_of_values(spark, tmp_path):
    header, zone, refused = ",".join(FIELDS), str(tmp_path / "zone"), str(tmp_path / "refused")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("one.csv", f"{header}\nwhole{',' * 13}\nmore{',' * 14}\n")
        archive.writestr("two.csv", f"{header}\nless{',' * 5}\n")
    with pytest.raises(Exception, match="wrong number of values"):
        loads.land_archives(spark, str(tmp_path), zone, DAY)
    assert not (tmp_path / "zone" / f"ingestion_date={DAY}").exists()
    loads.land_archives(spark, str(tmp_path), zone, DAY, rejects_table=refused)
    assert values(csv_by_position(spark, zone), "type") == [("whole",)]
    assert values(spark.read.parquet(refused), "entry", "record", "reject_reason") == [
        ("one.csv", f"more{',' * 14}", "column_count"),
        ("two.csv", f"less{',' * 5}", "column_count"),
    ]

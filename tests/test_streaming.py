import json
import os
import random
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadevents import queries
from roadevents.operators.normalize import normalize
from roadevents.schema import CENTRAL_SCHEMA, FIELDS
from roadevents.sinks import upsert
from roadevents.sources.envelope import json_envelope
from roadevents.streaming import changes, ingest
from roadevents.streaming.changes import changed_records
from roadevents.streaming.upsert import stream_merge, stream_rewrite_latest

START = "20240101080000"


class Landing:
    """Poll files with rising modification times."""

    def __init__(self, folder):
        self.folder, self.polls = folder, 0

    def poll(self, *items, day="2024-01-01"):
        self.polls += 1
        file = self.folder / f"ingestion_date={day}" / f"{self.polls}.json"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps({"body": {"items": items}}))
        os.utime(file, (1_700_000_000 + self.polls,) * 2)

    def csv(self, name, text):
        file = self.folder / "ingestion_date=2024-01-01" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path / "landing")


def item(link=1, start=START, **more):
    return {"startDate": start, "linkId": link, "coordX": link, **more}


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_each_file_is_loaded_once(spark, landing, path):
    folder, progress = str(landing.folder), path + "-progress"
    landing.poll(item(1), item(2))
    run(ingest.start_append(ingest.landed_stream(spark, folder), path, progress))
    landing.poll(item(3), day="2024-01-02")
    run(ingest.start_append(ingest.landed_stream(spark, folder), path, progress))
    loaded = spark.read.parquet(path)
    batch = json_envelope(spark, folder)
    same = ["startDate", "linkId", "seq", "file", "ingestion_date"]
    assert rows(loaded, *same) == rows(batch, *same) and loaded.count() == 3
    assert loaded.where("ingestion_date = date'2024-01-02'").count() == 1


def test_csv_stream(spark, landing, path):
    header = "type,eventType,eventDetailType,startDate,coordX,coordY,linkId,roadName,roadNo,roadDrcType,lanesBlockType,lanesBlocked,message,endDate"
    body = ",".join(["국도", "", "", START, "1", "2", "7", "", "", "", "", "", '"a\nb"', ""])
    landing.csv("a.csv", f"{header}\n{body}\n")
    stream = ingest.landed_stream(spark, str(landing.folder), "csv")
    run(stream_merge(stream, path, path + "-progress"))
    assert rows(upsert.read_table(spark, path), "type", "linkId", "message") == [("국도", 7, "a\nb")]
    with pytest.raises(ValueError):
        ingest.landed_stream(spark, str(landing.folder), "xml")


@pytest.mark.parametrize("max_files", [None, 1])
def test_merge_does_not_depend_on_the_batches(spark, landing, path, max_files):
    landing.poll(item(1, message="a"), item(2, message="b"), item(None, message="n1"))
    landing.poll(item(1, message="A", endDate="20240101090000"), item(1, message="later in poll"))
    landing.poll(item(3, message="c"), item(None, message="n3"), item(None, message="n4"))
    stream = ingest.landed_stream(spark, str(landing.folder), max_files=max_files)
    run(stream_merge(stream, path, path + "-progress"))
    table = upsert.read_table(spark, path)
    assert rows(table, "linkId", "message", "endDate") == [
        (1, "A", "20240101090000"),
        (2, "b", None),
        (3, "c", None),
        (None, "n1", None),
        (None, "n3", None),
    ]
    stamps = {r.message: r.ingestion_timestamp.timestamp() for r in table.collect()}
    assert stamps["A"] - stamps["b"] == 1


def test_a_replayed_batch_changes_nothing(spark, landing, path):
    landing.poll(item(1, message="a"), item(None, message="n"))
    for attempt in ("first", "second"):
        stream = ingest.landed_stream(spark, str(landing.folder))
        run(stream_merge(stream, path, f"{path}-{attempt}"))
    assert rows(upsert.read_table(spark, path), "message") == [("a",), ("n",)]


def test_bad_records_do_not_stop_the_stream(spark, landing, path):
    landing.poll(item(1), item("abc"), item("NULL"))
    stream = ingest.landed_stream(spark, str(landing.folder))
    run(stream_merge(stream, path, path + "-progress", null_markers=["NULL"]))
    assert rows(upsert.read_table(spark, path), "linkId") == [(1,), (None,)]


@pytest.mark.parametrize("max_files", [None, 1])
def test_latest_equals_the_batch_form(spark, landing, path, max_files):
    landing.poll(item(1, message="a"), item(None, message="n1"))
    landing.poll(item(1, message="b"), item(2, message="c"), item(None, message="n2"))
    stream = ingest.landed_stream(spark, str(landing.folder), max_files=max_files)
    run(stream_rewrite_latest(stream, path, path + "-progress"))
    table = upsert.read_table(spark, path, CENTRAL_SCHEMA)
    assert rows(table, "message") == [("b",), ("c",), ("n2",)]
    for poll in (1, 2):
        file = f"{landing.folder}/ingestion_date=2024-01-01/{poll}.json"
        batch = normalize(json_envelope(spark, file)).where("message <> 'x'")
        stamp = F.lit(f"2024-01-0{poll}").cast("timestamp")
        upsert.rewrite_latest(batch, path + "-batch", stamp=stamp)
    batch_table = upsert.read_table(spark, path + "-batch", CENTRAL_SCHEMA)
    columns = [c for c in CENTRAL_SCHEMA.names if c != "createdAt"]
    assert rows(batch_table, *columns) == rows(table, *columns)


def test_latest_poll_options(spark):
    frame = spark.createDataFrame(
        [("s", None, "2024-01-01", 1, "f1", "a"), ("s", None, "2024-01-01", 2, "f2", "b")],
        "startDate string, linkId long, ingestion_date string, polled_at long, file string, v string",
    )
    assert [r.v for r in ingest.latest_poll(frame).collect()] == ["b"]
    kept = ingest.latest_poll(frame, incomplete="per_poll")
    assert sorted(r.v for r in kept.collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        ingest.latest_poll(frame, incomplete="x")


ORDERS = [(0, 1, 2), (1, 0, 2), (2, 1, 0)]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("max_files", [None, 1])
def test_late_polls_lose_however_batches_are_cut(spark, landing, path, max_files, order):
    days = ["2024-02-01", "2024-02-02", "2024-02-03"]
    folder = str(landing.folder)
    merged, latest = path + "-merged", path + "-latest"
    for place in order:
        landing.poll(item(1, message=days[place]), item(place + 10, message="own"), day=days[place])
        if max_files:
            for start, table in ((stream_merge, merged), (stream_rewrite_latest, latest)):
                stream = ingest.landed_stream(spark, folder, max_files=max_files)
                run(start(stream, table, table + "-progress"))
    if not max_files:
        for start, table in ((stream_merge, merged), (stream_rewrite_latest, latest)):
            run(start(ingest.landed_stream(spark, folder), table, table + "-progress"))
    expected = [(1, "2024-02-03"), (10, "own"), (11, "own"), (12, "own")]
    assert rows(upsert.read_table(spark, merged), "linkId", "message") == sorted(expected, key=repr)
    table = upsert.read_table(spark, latest, CENTRAL_SCHEMA)
    assert rows(table, "linkId", "message") == sorted(expected, key=repr)


def test_streamed_csv_sets_wrong_numbers_of_values_apart(spark, landing, path):
    header, whole = ",".join(FIELDS), ",".join(["t", "", "", START, "1", "2", "7", *[""] * 7])
    refused, progress, folder = path + "-refused", path + "-progress", str(landing.folder)

    def take():
        run(ingest.start_typed_append(ingest.landed_stream(spark, folder, "csv"), path, refused, progress))

    landing.csv("a.csv", f"{header}\n{whole}\n{whole},surplus\n")
    take()
    landing.csv("b.csv", f"{header}\nshort,x\n{whole.replace('7', 'L')}\n")
    take()
    assert rows(spark.read.parquet(path), "type", "linkId", "batch") == [("t", 7, 0)]
    found = rows(spark.read.parquet(refused), "reject_reason", "batch")
    assert found == [("column_count", 0), ("column_count,startDate", 1), ("linkId", 1)] or found == [
        ("column_count", 0),
        ("column_count", 1),
        ("linkId", 1),
    ]
    # The merge leaves them out as well.
    run(stream_merge(ingest.landed_stream(spark, folder, "csv"), path + "-m", path + "-mp"))
    assert upsert.read_table(spark, path + "-m").count() == 1


def test_a_replayed_batch_replaces_both_outputs(spark, landing, path):
    header, whole = ",".join(FIELDS), ",".join(["t", "", "", START, "1", "2", "7", *[""] * 7])
    refused, progress, folder = path + "-refused", path + "-progress", str(landing.folder)
    landing.csv("a.csv", f"{header}\n{whole}\n{whole},surplus\n")
    for _ in range(2):
        run(ingest.start_typed_append(ingest.landed_stream(spark, folder, "csv"), path, refused, progress))
        # As after a crash before the batch was entered as done.
        for done in Path(progress, "commits").glob("*"):
            done.unlink()
    assert spark.read.parquet(path).count() == spark.read.parquet(refused).count() == 1


def test_only_changes_go_on(spark, landing, path):
    folder, progress = str(landing.folder), path + "-progress"

    def take():
        stream = changed_records(ingest.landed_stream(spark, folder), shares=3)
        run(ingest.start_append(stream, path, progress))

    landing.poll(item(1, message="a"), item(2, message="b"), item(2, message="second"), item(None, message="n"))
    take()
    landing.poll(item(1, message="a"), item(2, message="c"), item(None, message="n"), item(None, message="m"))
    landing.poll(item(1, message="a"), item(2, message="b"))
    take()
    # Back to what an earlier poll said is a change, too; a late poll is none.
    landing.poll(item(1, message="late"), item(3, message="new"), day="2023-12-31")
    take()
    found = rows(spark.read.parquet(path), "linkId", "message")
    assert found == [("1", "a"), ("2", "b"), ("2", "b"), ("2", "c"), ("3", "new"), (None, "m"), (None, "n")]


@pytest.mark.parametrize("max_files", [None, 1])
def test_changes_merge_to_the_same_table(spark, landing, path, max_files):
    rng = random.Random(5)
    for _ in range(6):
        links = rng.sample(range(9), 6)
        polled = [item(link, message=rng.choice("ab")) for link in links]
        landing.poll(*polled, day=rng.choice(["2024-01-01", "2024-01-02", "2024-01-03"]))
    stream = ingest.landed_stream(spark, str(landing.folder), max_files=max_files)
    run(stream_merge(stream, path, path + "-progress"))
    run(stream_merge(changed_records(stream, shares=4), path + "-c", path + "-c-progress"))
    whole, changed = (upsert.read_table(spark, p) for p in (path, path + "-c"))
    assert rows(changed, "linkId", "message") == rows(whole, "linkId", "message")


def test_forgotten_incidents_come_back(spark, landing, path):
    folder, progress = str(landing.folder), path + "-progress"

    def take(seconds):
        landing.poll(item(1, message="a"))
        file = landing.folder / "ingestion_date=2024-01-01" / f"{landing.polls}.json"
        os.utime(file, (1_700_000_000 + seconds,) * 2)
        stream = changed_records(ingest.landed_stream(spark, folder), forget="1 hour", shares=1)
        run(ingest.start_append(stream, path, progress))
        return spark.read.parquet(path).count()

    assert take(0) == 1
    assert take(3000) == 1
    assert take(6000) == 1  # seen less than an hour ago
    assert take(60_000) == 2
    assert take(61_000) == 2
    assert take(200_000) == 3


def test_compared_against_a_loop():
    rng = random.Random(3)
    names = changes._KNOWN
    for _ in range(40):
        polls = [(rng.randrange(3), rng.randrange(4), f"f{rng.randrange(3)}") for _ in range(12)]
        seen = sorted({(rng.randrange(4), 0, *p) for p in polls})
        records = [(*r, rng.randrange(2), 7) for r in seen]
        cut = rng.randrange(len(records) + 1)
        rng.shuffle(records)
        known, last = pd.DataFrame(columns=names), {}
        for part in (records[:cut], records[cut:]):
            fresh = pd.DataFrame(part, columns=names)
            kept, known = changes._compared(known, fresh, 2)
            expected = []
            for record in sorted(part):
                key, poll, said = record[:2], record[2:5], record[5:]
                if key in last and poll <= last[key][0]:
                    continue
                gone = key in last and poll[1] - last[key][0][1] > 2
                if key not in last or last[key][1] != said or gone:
                    expected.append(record)
                last[key] = (poll, said)
            assert sorted(tuple(fresh.loc[i]) for i in kept) == sorted(expected)
        assert {tuple(r[:2]): (tuple(r[2:5]), tuple(r[5:])) for r in known.itertuples(index=False)} == last


def test_first_record_of_a_poll():
    rng = random.Random(4)
    days = [1, 2, None]
    made = [(rng.randrange(3), 0, rng.choice(days), rng.randrange(2), f"f{rng.randrange(2)}") for _ in range(300)]
    found = pd.DataFrame([(*m, i, -i, rng.randrange(9)) for i, m in enumerate(made)], columns=[*changes._KNOWN, "seq"])
    first = changes._first(found, "seq")
    best = {}
    for place, i, poll in zip(found["seq"], found.index, made):
        best[poll] = min(best.get(poll, (place, i)), (place, i))
    assert sorted(first.index) == sorted(i for _, i in best.values())
    assert list(first.columns) == changes._KNOWN


def test_what_polls_say_is_made_in_one_pass(spark, monkeypatch, tmp_path):
    names = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([], names).write.parquet(str(tmp_path / "events.parquet"))
    made = []

    def responses(text, *extra):
        made.append(extra)
        raise InterruptedError

    monkeypatch.setattr(queries, "_responses", responses)
    with pytest.raises(InterruptedError):
        queries.stream_unchanged(spark, str(tmp_path))
    assert made == [("told",)]

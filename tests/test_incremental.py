"""Rollups kept current by days, sketches of days, and compaction."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadevents.plans import incremental, marts
from roadevents.plans.rollup import hourly_rollup, reports
from roadevents.schema import EVENT_SCHEMA, FIELDS
from roadevents.sinks import compact, files
from roadevents.sources.csv_files import csv_by_position

AS_OF = "2024-02-01 00:00:00"


def some(rng, n, days):
    rows = []
    for _ in range(n):
        day = rng.choice(days)
        start = None if day is None else dt.datetime(2024, 1, day, rng.randrange(24))
        end = rng.choice([None, dt.datetime(2024, 1, 31)])
        rows.append(
            {"type": rng.choice("ab"), "eventType": rng.choice("xyz"), "startDate": start, "endDate": end,
             "linkId": rng.randrange(40), "roadName": f"r{rng.randrange(9)}"}
        )
    return rows


def stamps(path):
    return {p.parent.name: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_only_touched_days_are_rolled_up_again(spark, events, tmp_path):
    rng, path, rollup, kept = random.Random(4), *[str(tmp_path / n) for n in ("events", "rollup", "sketches")]
    everything = []
    for days in ([1, 2, 3], [3, 4, None], [9], [2, None]):
        rows = some(rng, 60, days)
        everything += rows
        batch = events(*rows)
        incremental.append_events(batch, path)
        before = stamps(rollup)
        for _ in range(2):  # a repeated refresh changes nothing
            incremental.refresh_rollup(batch, path, rollup, as_of=AS_OF, sketches=kept)
        after = stamps(rollup)
        touched = {f"start_day=2024-01-0{d}" if d else "start_day=__HIVE_DEFAULT_PARTITION__" for d in days}
        assert {d for d in after if after[d] != before.get(d)} == touched
        whole = events(*everything)
        current = incremental.current_reports(spark, rollup)
        for name, report in reports(hourly_rollup(whole, as_of=AS_OF)).items():
            assert sorted(map(str, current[name].collect())) == sorted(map(str, report.collect())), name
    estimated = incremental.events_by_road_type_estimated(spark.read.parquet(kept))
    exact = marts.events_by_road_type(whole)
    assert estimated.columns == exact.columns
    for got, want in zip(estimated.collect(), exact.collect()):
        assert (got.road_type, got.total_events, got.active_days) == (want.road_type, want.total_events, want.active_days)
        assert abs(got.total_roads - want.total_roads) <= 1 and abs(got.unique_locations - want.unique_locations) <= 2


def test_sketches_stay_within_their_error(spark):
    rows = spark.range(200_000).selectExpr("*", "id % 30 AS d", "id % 50021 AS link")
    rows = rows.selectExpr(
        "'a' AS type", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(d)) AS startDate",
        "link AS linkId", "concat('r', link % 1013) AS roadName",
    )
    row = incremental.events_by_road_type_estimated(incremental.day_sketches(rows)).first()
    assert row.total_events == 200_000 and row.active_days == 30
    for got, want in ((row.unique_locations, 50021), (row.total_roads, 1013)):
        assert abs(got - want) <= 4 * incremental.STANDARD_ERROR * want


def days(spark, path, kind):
    return {r.day: r.files for r in compact.day_files(spark, path, kind).collect()}


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_many_polls_become_few_files(spark, raw, path, kind):
    land = files.land_csv if kind == "csv" else files.land_parquet
    for poll in range(48):
        land(raw({"type": str(poll), "message": 'a "q",\nb'}, {"type": ""}), path, "2024-01-01", mode="append")
    land(raw({"type": "other"}), path, "2024-01-02")
    read = csv_by_position if kind == "csv" else (lambda s, p: s.read.parquet(p))
    rows = lambda: sorted(map(str, read(spark, path).select(*FIELDS, "ingestion_date").collect()))
    before, found = days(spark, path, kind), rows()
    assert before == {"2024-01-01": 48, "2024-01-02": 1}
    assert compact.compact_days(spark, path, kind) == ["2024-01-01"]
    assert days(spark, path, kind) == {"2024-01-01": 1, "2024-01-02": 1}
    assert rows() == found and len(found) == 97
    assert compact.compact_days(spark, path, kind) == []


def test_compaction_that_fails_or_has_nothing_to_do(spark, raw, path):
    assert compact.compact_days(spark, path) == []
    for _ in range(3):
        files.land_csv(raw({"type": "a"}), path, "2024-01-01", mode="append")
    broken = Path(path, "ingestion_date=2024-01-01", "bad.csv")
    broken.write_text(",".join(FIELDS) + "\nshort,x\n")
    before = sorted(p.name for p in broken.parent.glob("*.csv"))
    with pytest.raises(Exception, match="wrong number of values"):
        compact.compact_days(spark, path, "csv", max_files=2)
    assert sorted(p.name for p in broken.parent.glob("*.csv")) == before
    # Files that are large already stay.
    assert compact.compact_days(spark, path, "csv", max_files=2, large_bytes=1) == []
    with pytest.raises(ValueError, match="kind"):
        compact.compact_days(spark, path, "json")


def test_the_day_of_nulls_is_compacted_too(spark, events, path):
    for _ in range(3):
        frame = events({"type": "a"}, schema=EVENT_SCHEMA).withColumn("ingestion_date", F.lit(None).cast("date"))
        files.land_parquet(frame, path, mode="append")
    assert compact.compact_days(spark, path, max_files=2) == ["__HIVE_DEFAULT_PARTITION__"]
    assert spark.read.parquet(path).count() == 3

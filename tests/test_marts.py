import datetime as dt

import pytest

from conftest import DATA
from roadevents.fixtures import AS_OF, incident_events
from roadevents.operators.quality import (
    AcceptedRange,
    NotNull,
    check_model,
    failing_rows,
    require_passing,
    require_rows,
)
from roadevents.sinks import files, tables
from roadevents.plans import marts, models
from roadevents.plans.rollup import hourly_rollup, reports

SUNDAY = dt.datetime(2025, 11, 16, 8, 30)


def at(minutes=0, **fields):
    start = fields.pop("start", SUNDAY)
    return {"startDate": start, "endDate": start + dt.timedelta(minutes=minutes), **fields}


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def sample(spark):
    return incident_events(spark, f"{DATA}/sf0.001").cache()


def test_shares_sum_and_null_group(events):
    frame = events(*[{"eventType": t} for t in ("a", "a", None)])
    assert rows(marts.event_type_summary(frame)) == [("a", 2, 66.67), (None, 1, 33.33)]


def test_ties_are_ordered_by_the_group(events):
    frame = events(*[{"eventType": t} for t in ("b", "a", None)])
    assert [r[0] for r in rows(marts.event_type_summary(frame))] == ["a", "b", None]


def test_distinct_counts_ignore_nulls(events):
    frame = events(
        at(type="x", roadName="r", linkId=1), at(type="x", roadName="r", linkId=2),
        {"type": "x"}, at(type=None),
    )
    assert rows(marts.events_by_road_type(frame)) == [("x", 3, 1, 1, 2)]
    assert rows(marts.events_by_road_type(frame, approximate=True)) == [("x", 3, 1, 1, 2)]


def test_null_start(events):
    frame = events(at(), {"type": "x"})
    assert rows(marts.daily_event_count(frame)) == [(SUNDAY.date(), 1), (None, 1)]
    assert rows(marts.weekday_event_count(frame)) == [("Sun", 1, 1)]
    assert rows(marts.hourly_event_heatmap(frame)) == [("일", 8, 1, 1)]
    assert rows(marts.duration_buckets(frame, as_of=AS_OF)) == [("00~30분", 1), ("24시간 이상", 1)]
    assert rows(marts.avg_duration_by_hour(frame, as_of=AS_OF))[1] == (None, None)


def test_heatmap_over_text(spark):
    texts = ["20251116083000", "2025-11-16 08:10", "20251399083000", "2025111", "20251116", " ", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "startDate string")
    assert sorted(rows(marts.hourly_event_heatmap(frame)), key=repr) == sorted(
        [("일", 8, 2, 1), ("일", None, 1, 1), (None, 8, 1, None), (None, None, 1, None)], key=repr
    )


def test_open_and_negative_durations(events):
    open_incident = {"startDate": SUNDAY, "type": "x", "eventType": "e"}
    frame = events(at(-5, type="x", eventType="e"), open_incident)
    as_of = SUNDAY + dt.timedelta(minutes=65)
    assert rows(marts.avg_duration_by_type(frame, as_of=as_of)) == [("x", "e", 2, 30.0)]
    assert rows(marts.event_type_duration_stats(frame, as_of=as_of)) == [("e", 2, 30.0, -5, 65)]
    assert rows(marts.duration_buckets(frame, as_of=as_of)) == [("00~30분", 1), ("1~2시간", 1)]
    assert rows(marts.avg_duration_hours_by_road_type(frame)) == [("x", 0.083333)]
    assert sorted(r[-1] for r in rows(marts.event_durations(frame, as_of=as_of))) == [-5, 65]


def test_a_type_with_only_open_incidents_comes_first(events):
    frame = events({"startDate": SUNDAY, "type": "open"}, at(60, type="closed"))
    assert rows(marts.avg_duration_hours_by_road_type(frame)) == [("open", None), ("closed", 1.0)]


def test_totals_agree(sample):
    total = sample.count()
    summary = rows(marts.event_type_summary(sample))
    assert abs(sum(r[2] for r in summary) - 100) <= 0.01 * len(summary)
    for mart, position in (
        (marts.event_type_summary, 1), (marts.daily_event_count, 1),
        (marts.hourly_event_heatmap, 2), (marts.weekday_event_count, 2),
        (marts.avg_duration_by_type, 2), (marts.duration_buckets, 1),
        (marts.event_type_duration_stats, 1),
    ):
        assert sum(r[position] for r in rows(mart(sample, as_of=AS_OF))) == total


def test_one_pass_reports_equal_the_marts(events, sample):
    edges = events(
        at(-5), {"type": "x"}, at(45, type="x", eventType="e"), {"startDate": SUNDAY}, {"endDate": SUNDAY},
    )
    for frame in (sample, edges):
        for name, report in reports(hourly_rollup(frame, as_of=AS_OF)).items():
            mart = models.MODELS[name].build(frame, as_of=AS_OF)
            assert rows(report) == rows(mart), name
            assert report.dtypes == mart.dtypes, name


def test_quality_checks(spark):
    frame = spark.createDataFrame([(0,), (1000,), (1001,), (-1,), (None,)], "n long")
    in_range = AcceptedRange("n", 0, 1000)
    assert sorted(r.n for r in failing_rows(frame, in_range).collect()) == [-1, 1001]
    report = check_model("m", frame, [NotNull("n"), in_range])
    assert rows(report) == [("m", "n", "not_null", 1), ("m", "n", "accepted_range", 2)]
    with pytest.raises(ValueError, match="m.n not_null: 1, m.n accepted_range: 2"):
        require_passing(report)
    assert require_passing(check_model("m", frame.where("n = 0"), [NotNull("n")])) is not None


def test_empty_batch_is_refused(spark):
    assert require_rows(spark.range(1)).count() == 1
    with pytest.raises(ValueError):
        require_rows(spark.range(0))


@pytest.mark.parametrize("one_pass", [True, False])
def test_run_models(spark, sample, events, path, one_pass):
    rollup = path if one_pass else None
    report = models.run_models(sample, as_of=AS_OF, rollup=rollup)
    assert [r.failures for r in report.collect()] == [0, 0, 0]
    assert spark.table("event_type_summary").count() == 5
    assert {t.name for t in spark.catalog.listTables()} >= set(models.MODELS)
    with pytest.raises(ValueError, match="daily_event_count.event_date not_null: 1"):
        models.run_models(events({"type": "x"}), as_of=AS_OF, rollup=rollup)
    spark.sql("drop table event_type_summary")


def test_views_follow_their_events(spark, events, path):
    files.full_refresh(events(at(5)), path)
    models.run_models(spark.read.parquet(path), kinds={"event_type_summary": "view"})
    files.append_load(events(at(7)), path)
    stored = spark.read.parquet(path)
    models.run_models(stored, kinds={"event_type_summary": "view"})
    assert spark.table("daily_event_count").first().event_count == 2
    one_clock = spark.table("event_durations").select("duration_minutes")
    assert one_clock.collect() == one_clock.collect()


def test_a_failed_test_stops_the_publication(spark):
    good = spark.sql("SELECT date'2024-01-01' AS event_date, 5L AS event_count")
    checks = models.MODELS["daily_event_count"].checks
    assert models.publish_tested(good, "tested", checks) == [
        ("tested", "event_date", "not_null", 0),
        ("tested", "event_count", "not_null", 0),
        ("tested", "event_count", "accepted_range", 0),
    ]
    bad = good.union(spark.sql("SELECT date(NULL), 2000L")).union(good)
    with pytest.raises(ValueError, match="tested.event_date not_null: 1, tested.event_count accepted_range: 1"):
        models.publish_tested(bad, "tested", checks)
    assert spark.table("tested").count() == 1
    found = models.publish_tested(bad, "tested", checks, strict=False)
    assert [n for *_, n in found] == [1, 0, 1] and spark.table("tested").count() == 3
    tables.drop(spark, "tested")

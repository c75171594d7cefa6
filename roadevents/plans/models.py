"""The set of published models, their tests, and the run that builds and tests all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from roadevents.functions.times import AsOf
from roadevents.operators.quality import (
    AcceptedRange,
    Check,
    NotNull,
    dq_report,
    fail_if_any,
    observed,
    outcome,
    require_passing,
)
from roadevents.plans import marts
from roadevents.plans.rollup import reports_in_one_pass
from roadevents.sinks.tables import materialize, publish


@dataclass(frozen=True)
class Model:
    """``source`` names the model it reads; None is the event table."""

    build: Callable[..., DataFrame]
    source: str | None = None
    kind: str = "view"
    checks: list[Check] = field(default_factory=list)


MODELS = {
    "src_events": Model(marts.src_events),
    "stg_event_info": Model(marts.stg_event_info),
    "event_type_summary": Model(
        marts.event_type_summary, source="stg_event_info", kind="table"
    ),
    "events_by_road_type": Model(
        marts.events_by_road_type, source="src_events"
    ),
    "daily_event_count": Model(
        marts.daily_event_count,
        checks=[
            NotNull("event_date"),
            NotNull("event_count"),
            AcceptedRange("event_count", 0, 1000),
        ],
    ),
    "hourly_event_heatmap": Model(marts.hourly_event_heatmap),
    "weekday_event_count": Model(marts.weekday_event_count),
    "avg_duration_by_type": Model(marts.avg_duration_by_type),
    "avg_duration_by_hour": Model(marts.avg_duration_by_hour),
    "avg_duration_hours_by_road_type": Model(marts.avg_duration_hours_by_road_type),
    "duration_buckets": Model(marts.duration_buckets),
    "event_type_duration_stats": Model(marts.event_type_duration_stats),
    "event_durations": Model(marts.event_durations),
}


def build_models(
    events: DataFrame, *, as_of: AsOf = None, rollup: str | None = None
) -> dict[str, DataFrame]:
    """Every model as a DataFrame, in order of dependence.

    Each reads the events when it is read. With ``rollup``, a folder, the models that
    aggregate by type or time read a table that is written there from one pass over the
    events, and show the events as they are now.
    """
    shared = reports_in_one_pass(events, rollup, as_of=as_of) if rollup else {}
    built: dict[str, DataFrame] = {}
    for name, model in MODELS.items():
        if name in shared:
            built[name] = shared[name]
        else:
            source = built[model.source] if model.source else events
            built[name] = model.build(source, as_of=as_of)
    return built


def report(models: dict[str, DataFrame]) -> DataFrame:
    """The outcome of every model's tests."""
    return dq_report(models, {n: m.checks for n, m in MODELS.items() if n in models})


def publish_tested(
    df: DataFrame, name: str, checks: list[Check], *, strict: bool = True, keep: int = 2
) -> list[tuple[str, str, str, int]]:
    """Publishes a model as a table and tests it while it is written, in one pass.

    ``strict`` raises if a test fails, before the table is switched: readers keep the
    version that passed. The summary has model, column, test and failures.
    """
    found: list[tuple[str, str, str, int]] = []

    def write(rows: DataFrame, path: str) -> None:
        rows.write.parquet(path)
        found.extend((name, *result) for result in outcome(seen, checks))
        if strict:
            fail_if_any(found)

    rows, seen = observed(df, checks)
    publish(rows, name, keep=keep, write=write)
    return found


def publish_models(
    events: DataFrame,
    *,
    as_of: AsOf = None,
    prefix: str = "",
    strict: bool = True,
    rollup: str | None = None,
) -> DataFrame:
    """Publishes every model that has tests as a table ``prefix`` + name, each tested during
    its one write; the summary of all tests. ``rollup`` is that of ``build_models``."""
    spark = events.sparkSession
    found = []
    for name, df in build_models(events, as_of=as_of, rollup=rollup).items():
        checks = MODELS[name].checks
        if checks:
            tested = publish_tested(df, prefix + name, checks, strict=strict)
            found += [(name, *result[1:]) for result in tested]
    return spark.createDataFrame(found, "model string, column string, test string, failures long")


def run_models(
    events: DataFrame,
    *,
    as_of: AsOf = None,
    kinds: dict[str, str] | None = None,
    strict: bool = True,
    rollup: str | None = None,
) -> DataFrame:
    """Publishes all models, then tests them; ``strict`` raises if a test fails.

    ``kinds`` overrides per model whether it becomes a ``"view"`` or a ``"table"``;
    ``rollup`` is that of ``build_models``. All models measure open incidents to one
    instant: ``as_of``, or the start of the run.
    """
    kinds = kinds or {}
    if as_of is None:
        as_of = events.sparkSession.sql("SELECT string(localtimestamp())").first()[0]
    published = {
        name: materialize(df, name, kinds.get(name, MODELS[name].kind))
        for name, df in build_models(events, as_of=as_of, rollup=rollup).items()
    }
    summary = report(published)
    return require_passing(summary) if strict else summary

"""Column tests over result tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    """Fails for every null."""

    column: str
    name: str = "not_null"

    def failure(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedRange:
    """Fails outside the inclusive bounds; a null passes."""

    column: str
    low: float
    high: float
    name: str = "accepted_range"

    def failure(self) -> Column:
        value = F.col(self.column)
        return F.coalesce((value < self.low) | (value > self.high), F.lit(False))


Check = NotNull | AcceptedRange

SUMMARY = ("model", "column", "test", "failures")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a test objects to."""
    return df.where(check.failure())


def check_model(model: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    """One summary row per test, all counted in one pass over the model."""
    counted = df.agg(
        *[F.count_if(c.failure()).alias(_failures(i)) for i, c in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(c.column).alias("column"),
                F.lit(c.name).alias("test"),
                F.col(_failures(i)).alias("failures"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def observed(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, Observation]:
    """The frame, and what its tests find while it is read or written for another purpose.

    The observation is complete after the first action on the returned frame.
    """
    seen = Observation()
    counts = [F.count_if(c.failure()).alias(_failures(i)) for i, c in enumerate(checks)]
    return df.observe(seen, *counts), seen


def outcome(seen: Observation, checks: list[Check]) -> list[tuple[str, str, int]]:
    """column, test and number of failures of every observed test."""
    found = seen.get
    return [(c.column, c.name, found[_failures(i)]) for i, c in enumerate(checks)]


def _failures(i: int) -> str:
    return f"_failures_{i}"


def dq_report(
    models: dict[str, DataFrame], checks: dict[str, list[Check]]
) -> DataFrame:
    """Summary ``(model, column, test, failures)`` over all models that have tests."""
    parts = [check_model(m, models[m], tests) for m, tests in checks.items() if tests]
    return reduce(DataFrame.unionByName, parts)


def require_rows(df: DataFrame) -> DataFrame:
    """The frame itself, or an error when it is empty."""
    if df.isEmpty():
        raise ValueError("the batch holds no events")
    return df


def require_passing(report: DataFrame) -> DataFrame:
    """The report itself, or an error naming the tests that failed."""
    fail_if_any(tuple(r) for r in report.select(*SUMMARY).collect())
    return report


def fail_if_any(found: Iterable[tuple[str, str, str, int]]) -> None:
    """An error naming the tests of a summary that failed, if there are any."""
    failed = [f"{model}.{column} {test}: {n}" for model, column, test, n in found if n]
    if failed:
        raise ValueError(f"data tests failed: {', '.join(failed)}")

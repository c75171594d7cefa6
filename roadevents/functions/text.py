"""Lenient text-to-value expressions; unparseable text gives null, never an error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_if(text: Column, markers: Iterable[str]) -> Column:
    """Null where the text equals one of the markers exactly."""
    markers = list(markers)
    if not markers:
        return text
    return F.when(~text.isin(markers), text)


def to_double(text: Column) -> Column:
    """Plain decimal or exponent notation only: no NaN, infinity or type suffix."""
    return F.when(text.rlike(r"^\s*[-+0-9.][-+0-9.eE]*\s*$"), text.try_cast("double"))


def to_long(text: Column) -> Column:
    """Whole number, also written with decimals (``110.0``); half rounds away from zero.

    The decimal route keeps 19-digit identifiers exact.
    """
    return F.round(text.try_cast("decimal(38,18)"), 0).try_cast("bigint")


def to_timestamp14(text: Column) -> Column:
    """``yyyyMMddHHmmss`` text to a zone-free timestamp."""
    date = F.concat_ws("-", *[F.substring(text, i, n) for i, n in ((1, 4), (5, 2), (7, 2))])
    time = F.concat_ws(":", *[F.substring(text, i, 2) for i in (9, 11, 13)])
    iso = F.concat_ws(" ", date, time)
    return F.when(text.rlike(r"^\d{14}$"), iso.try_cast("timestamp_ntz"))


def digits(value: Column) -> Column:
    """The digits of a value's text form."""
    return F.regexp_replace(value.cast("string"), "[^0-9]", "")


def leading_date(digit_text: Column) -> Column:
    """The date in the first eight digits; null if they are fewer or no date."""
    iso = F.concat_ws(
        "-",
        F.substring(digit_text, 1, 4),
        F.substring(digit_text, 5, 2),
        F.substring(digit_text, 7, 2),
    )
    return F.when(F.length(digit_text) >= 8, iso.try_cast("date"))


def leading_hour(digit_text: Column) -> Column:
    """Digits nine and ten as a number, not range-checked; null if absent."""
    return F.when(
        F.length(digit_text) >= 10, F.substring(digit_text, 9, 2).try_cast("int")
    )


def not_blank(value: Column) -> Column:
    """Neither null nor, as text, empty or spaces only."""
    return value.isNotNull() & (F.trim(value.cast("string")) != "")


def joined_key(*parts: Column) -> Column:
    """The parts joined by underscores; a missing part counts as empty."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text; missing values stay null."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])

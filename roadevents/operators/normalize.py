"""Raw text records to typed events, with bad rows kept apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadevents.functions import text
from roadevents.schema import (
    DATE_FIELDS,
    DOUBLE_FIELDS,
    END_DATE_BLANKS,
    FIELDS,
    LONG_FIELDS,
    NUMBER_BLANKS,
)

REASON = "reject_reason"
CORRUPT = "_corrupt_record"


def apply_null_markers(df: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Null in place of every text value that equals a marker."""
    kinds = dict(df.dtypes)
    return df.select(
        [
            text.null_if(F.col(c), markers).alias(c) if kinds[c] == "string" else F.col(c)
            for c in df.columns
        ]
    )


def _converted_fields(dates: str) -> list[str]:
    if dates not in ("timestamp", "text"):
        raise ValueError(f"dates must be 'timestamp' or 'text', not {dates!r}")
    special = DOUBLE_FIELDS + LONG_FIELDS
    if dates == "timestamp":
        special += DATE_FIELDS
    return [f for f in FIELDS if f in special]


def _blanks(field: str) -> Sequence[str]:
    """Text that means no value. A blank start is a bad record, not a missing value."""
    if field in DOUBLE_FIELDS + LONG_FIELDS:
        return NUMBER_BLANKS
    return END_DATE_BLANKS if field == "endDate" else ()


def _convert(field: str, present: Column) -> Column:
    if field in DOUBLE_FIELDS:
        return text.to_double(present)
    if field in LONG_FIELDS:
        return text.to_long(present)
    return text.to_timestamp14(present)


def _text(field: str) -> str:
    return f"_text_{field}"


def _value(field: str) -> str:
    return f"_value_{field}"


def _bad(field: str) -> Column:
    return F.col(_text(field)).isNotNull() & F.col(_value(field)).isNull()


def _with_step(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Adds columns by generating them, which later filters are not pushed into.

    As plain projections, the filter on bad rows would carry copies of every
    conversion, and the compiled method would outgrow what the JVM optimises.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def _converted(
    raw: DataFrame, fields: list[str], null_markers: Sequence[str]
) -> DataFrame:
    """The raw rows with, per field, its text less missing values, and its value."""
    texts = [
        text.null_if(F.col(f), [*null_markers, *_blanks(f)]).alias(_text(f))
        for f in fields
    ]
    values = [_convert(f, F.col(_text(f))).alias(_value(f)) for f in fields]
    return _with_step(_with_step(raw, texts), values)


def _is_bad(raw: DataFrame, fields: list[str]) -> Column:
    corrupt = [F.col(CORRUPT).isNotNull()] if CORRUPT in raw.columns else []
    return reduce(or_, corrupt + [_bad(f) for f in fields])


def _reason(raw: DataFrame, fields: list[str]) -> Column:
    """Comma-joined names of the fields that do not convert."""
    bad = [F.when(_bad(f), f) for f in fields]
    if CORRUPT in raw.columns:
        bad.insert(0, F.when(F.col(CORRUPT).isNotNull(), "column_count"))
    return F.concat_ws(",", *bad)


def normalize(
    raw: DataFrame,
    *,
    dates: str = "timestamp",
    null_markers: Sequence[str] = (),
    on_error: str = "continue",
) -> DataFrame:
    """Typed events from raw text rows; columns beyond the record's fields pass through.

    ``on_error="continue"`` leaves bad rows out (``rejects`` returns them),
    ``"abort"`` fails the job at the first one. ``dates="text"`` keeps the source
    text of the dates.
    """
    fields = _converted_fields(dates)
    bad = _is_bad(raw, fields)
    if on_error == "continue":
        keep = ~bad
    elif on_error == "abort":
        # Part of the filter, so that column pruning cannot remove the check.
        message = F.concat(F.lit("bad record, fields: "), _reason(raw, fields))
        keep = F.when(~bad, True).otherwise(F.raise_error(message).cast("boolean"))
    else:
        raise ValueError(f"on_error must be 'continue' or 'abort', not {on_error!r}")
    typed = [
        F.col(_value(f)).alias(f)
        if f in fields
        else text.null_if(F.col(f), null_markers).alias(f)
        for f in FIELDS
    ]
    extra = [c for c in raw.columns if c not in FIELDS and c != CORRUPT]
    return _converted(raw, fields, null_markers).where(keep).select(*typed, *extra)


def rejects(
    raw: DataFrame, *, dates: str = "timestamp", null_markers: Sequence[str] = ()
) -> DataFrame:
    """The raw rows ``normalize`` leaves out, with the fields at fault."""
    fields = _converted_fields(dates)
    return (
        _converted(raw, fields, null_markers)
        .where(_is_bad(raw, fields))
        .select(*raw.columns, _reason(raw, fields).alias(REASON))
    )

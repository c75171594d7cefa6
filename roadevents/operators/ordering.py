"""Sort orders with the warehouse's placing of nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def descending(*names: str) -> list[Column]:
    """Largest first, nulls before everything."""
    return [F.desc_nulls_first(n) for n in names]


def ascending(*names: str) -> list[Column]:
    """Smallest first, nulls after everything."""
    return [F.asc_nulls_last(n) for n in names]

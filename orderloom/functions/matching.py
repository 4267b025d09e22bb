"""Text comparisons, optionally without regard to case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_of(column: Column, values: list[str], ignore_case: bool = False) -> Column:
    if ignore_case:
        return F.lower(column).isin([v.lower() for v in values])
    return column.isin(values)


def equals(column: Column, value: str, ignore_case: bool = False) -> Column:
    return F.lower(column) == value.lower() if ignore_case else column == value


def ends_with(column: Column, suffix: str, ignore_case: bool = False) -> Column:
    return F.lower(column).endswith(suffix.lower()) if ignore_case else column.endswith(suffix)


def like(column: Column, pattern: str, ignore_case: bool = False) -> Column:
    return column.ilike(pattern) if ignore_case else column.like(pattern)


def class_name(column: Column) -> Column:
    r"""Last part of a class path: App\Models\Invoice -> Invoice."""
    return F.substring_index(column, "\\", -1)

"""Date and time arithmetic."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(when: datetime) -> Column:
    """A point in time as text: Spark casts the literal to the type of the compared column,
    so the comparison is pushed to the scan for zoned and zoneless columns alike."""
    return F.lit(when.isoformat(sep=" "))


def days_between(later: Column, earlier: Column) -> Column:
    """Calendar days; the times of day do not count."""
    return F.datediff(later, earlier)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (later - earlier).cast("interval second").cast("bigint")


def plus_days(when: Column, days: Column) -> Column:
    """`when` moved by whole days, with its time of day kept."""
    return when + F.make_dt_interval(days)


def changed_after(column: Column, since: datetime) -> Column:
    """True when the row is newer; NULL, which filters drop, when it has no time."""
    return column > moment(since)


def changed_in(columns: tuple[str, ...], since: datetime) -> Column:
    """True when any of the times is newer."""
    return reduce(lambda a, b: a | b, [changed_after(F.col(c), since) for c in columns])

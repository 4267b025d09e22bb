"""Rows as comma-separated lists of text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listed(
    rows: DataFrame, key: str, when: str, amount: str, names: tuple[str, str],
    also: Mapping[str, Column] | None = None, together: bool = False,
) -> DataFrame:
    """Per key the days and amounts of its rows as two texts, called `names`, one entry per row.

    Entries are in order of day, then amount, missing ones first and empty; a text is NULL if none
    of its entries is known. The n-th entries of the two belong together. Equal rows are counted
    before they are shuffled, a day's entries are put together first, and then the days, so no task
    sorts more than the different amounts of a day, or the days of a key.

    `also` are further aggregates, of rows with their number as `n`. With `together` the rows are
    shuffled once, by key, and a key's different rows are sorted in one step, which takes a third of
    the time: for keys of which none has so many rows that one task should not sort them.
    """
    if together:
        rows = rows.repartition(key)
    equal = rows.groupBy(key, when, amount).agg(F.count(F.lit(1)).cast("int").alias("n"))
    every = (_in_one_step if together else _by_day)(equal, key, when, amount, also or {})
    first, second = names
    # Each entry has brought its comma.
    return every.select(
        key,
        F.when(F.col("dated") > 0, F.expr("substring(dates, 1, length(dates) - 1)")).alias(first),
        F.when(F.col("known") > 0, F.expr("substring(amounts, 1, length(amounts) - 1)")).alias(second),
        *(also or {}),
    )


def _entries(value: Column, n: Column) -> Column:
    return F.repeat(F.concat(F.coalesce(value.cast("string"), F.lit("")), F.lit(",")), n)


def _by_day(equal: DataFrame, key: str, when: str, amount: str, also: Mapping[str, Column]) -> DataFrame:
    equal = equal.withColumn("entries", _entries(F.col(amount), F.col("n")))
    days = equal.groupBy(key, when).agg(
        F.expr(f"listagg(entries, '') within group (order by {amount} nulls first)").alias("amounts"),
        F.sum("n").cast("int").alias("n"),
        F.count(amount).alias("known"),
    )
    days = days.withColumn("dates", _entries(F.col(when), F.col("n")))

    def text(column: str) -> str:
        return f"listagg({column}, '') within group (order by {when} nulls first)"

    return days.groupBy(key).agg(
        F.expr(text("dates")).alias("dates"),
        F.expr(text("amounts")).alias("amounts"),
        F.count(when).alias("dated"),
        F.sum("known").alias("known"),
        *[value.alias(name) for name, value in also.items()],
    )


def _in_one_step(equal: DataFrame, key: str, when: str, amount: str, also: Mapping[str, Column]) -> DataFrame:
    found = equal.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(when, amount, "n"))).alias("_rows"),
        F.count(when).alias("dated"),
        F.count(amount).alias("known"),
        *[value.alias(name) for name, value in also.items()],
    )

    def text(column: str) -> Column:
        return F.array_join(F.transform("_rows", lambda row: _entries(row[column], row["n"])), "")

    return found.withColumns({"dates": text(when), "amounts": text(amount)})

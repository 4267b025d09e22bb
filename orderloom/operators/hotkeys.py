"""Joins that stay balanced when single keys hold a large part of a table.

A shuffle sends all rows of a key to one task. `hot_keys` finds the keys for which that
would be too many, in one pass and without shuffling the keys; `attach` and `expand` then
cut just those keys into slices. Results are those of a plain join whatever is found, and
without hot keys the plan is a plain join too.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from contextvars import copy_context
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Hot = dict[Any, int]
_SLICE, _SLICES = "_slice", "_slices"


class Searches:
    """Small jobs that a plan needs the results of, run side by side.

    Each is started by name as soon as it is known to be needed; asking for it waits for it.
    """

    def __init__(self, at_once: int = 8):
        self._pool = ThreadPoolExecutor(at_once, thread_name_prefix="search")
        self._found: dict[str, Future] = {}

    def start(self, name: str, search: Callable[..., Any], *args: Any) -> None:
        self._found[name] = self._pool.submit(copy_context().run, search, *args)

    def __getitem__(self, name: str) -> Any:
        return self._found[name].result()

    def __enter__(self) -> Searches:
        return self

    def __exit__(self, *error: object) -> None:
        self._pool.shutdown(cancel_futures=True)


def hot_keys(df: DataFrame, *columns: str) -> dict[str, Hot]:
    """For each column: keys with more rows than an average shuffle partition -> slices.

    NULL is a key like any other here, as outer joins shuffle NULL keys to one task. There
    can be no more such keys than shuffle partitions, which bounds the result. Counts come
    from a mergeable sketch (`approx_top_k`); they only decide how finely a key is cut. The
    sketch tracks many more keys than can be hot; its limit of a million bounds its memory and
    leaves no row out.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(16 * partitions + 1024, 1_000_000)
    top = min(partitions, tracked)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k(`{c}`, {top}, {tracked})").alias(c) for c in columns],
    ).first()
    fair = max(found["rows"] / partitions, 1.0)
    return {
        c: {
            key["item"]: min(math.ceil(key["count"] / fair) + 1, partitions)
            for key in found[c]
            if key["count"] > fair
        }
        for c in columns
    }


def heavy_keys(weights: DataFrame, key: str, weight: str) -> Hot:
    """Keys whose weight, one row per key, is over the fair share of a shuffle partition.

    There can be no more such keys than shuffle partitions.
    """
    partitions = int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = weights.select(F.col(key).alias("key"), F.col(weight).alias("weight"), F.lit(True).alias("single"))
    total = rows.agg(F.sum("weight").alias("weight")).select(
        F.lit(None).cast(weights.schema[key].dataType).alias("key"), "weight", F.lit(False).alias("single")
    )
    # Both from one job, which computes the weights once.
    found = rows.orderBy(F.desc("weight")).limit(partitions).unionByName(total).collect()
    fair = max(next(r["weight"] for r in found if not r["single"]) or 0, 0) / partitions
    fair = max(fair, 1.0)
    return {
        r["key"]: min(math.ceil(r["weight"] / fair) + 1, partitions)
        for r in found
        if r["single"] and r["weight"] > fair
    }


def none_heavy(rows: DataFrame, key: str, most: int) -> bool:
    """Whether a sketch proves that no key is over the fair share, if each row weighs from 1 to `most`.

    One pass without a shuffle. The sketch gives no key a count too low, and leaves out none of over
    5.3 rows in as many as it tracks, which is less here than a key of that weight has. False only
    means that the weights have to be summed.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = 8 * partitions * most + 1024
    if tracked > 1_000_000:
        return False
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{key}`, 1, {tracked})").alias("top")
    ).first()
    return all(top["count"] * most * partitions <= found["rows"] for top in found["top"])


def _slices(df: DataFrame, key: str, hot: Hot) -> DataFrame:
    """Add the number of slices of the row's key: NULL unless it is hot."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    table = spark.createDataFrame(list(hot.items()), f"_hot {kind}, {_SLICES} int")
    # At most one row per shuffle partition, see hot_keys.
    return df.join(F.broadcast(table), F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")


def _cut(df: DataFrame, key: str, hot: Hot, spread: list[str]) -> DataFrame:
    """Put each row of a hot key into one slice, the same one whenever it is recomputed."""
    at = F.pmod(F.xxhash64(*spread), F.coalesce(F.col(_SLICES), F.lit(1)).cast("bigint"))
    return _slices(df, key, hot).withColumn(_SLICE, at.cast("int")).drop(_SLICES)


def _copy(df: DataFrame, key: str, hot: Hot) -> DataFrame:
    """Copy each row of a hot key into every slice."""
    every = F.sequence(F.lit(0), F.coalesce(F.col(_SLICES), F.lit(1)) - 1)
    return _slices(df, key, hot).withColumn(_SLICE, F.explode(every)).drop(_SLICES)


def attach(
    left: DataFrame, right: DataFrame, key: str, hot: Hot, spread: list[str], how: str = "left"
) -> DataFrame:
    """Join where `left` may have hot keys and `right` has few rows per key.

    `spread` are columns of `left` that tell the rows of one key apart.
    """
    if not hot:
        return left.join(right, key, how)
    # A NULL key matches nothing: its rows are cut, and there is nothing to copy.
    keyed = {k: n for k, n in hot.items() if k is not None}
    copies = _copy(right, key, keyed) if keyed else right.withColumn(_SLICE, F.lit(0))
    return _cut(left, key, hot, spread).join(copies, [key, _SLICE], how).drop(_SLICE)


def expand(
    left: DataFrame, right: DataFrame, key: str, hot: Hot, spread: list[str], also: DataFrame | None = None
) -> DataFrame:
    """Left join where `right` may have hot keys and `left` has few rows per key.

    `hot` must come from `right` itself: a hot key then surely has a match, so a copy of a
    left row whose slice is empty can be dropped without losing the row. `also` has a row per
    key at most and is left joined to `left` before, in the same slices, so that `left` is
    shuffled once.
    """
    keyed = {k: n for k, n in hot.items() if k is not None}
    if not keyed:
        left = left if also is None else left.join(also, key, "left")
        return left.join(right, key, "left")
    copies = _slices(left, key, keyed)
    every = F.sequence(F.lit(0), F.coalesce(F.col(_SLICES), F.lit(1)) - 1)
    copies = copies.withColumn(_SLICE, F.explode(every))
    if also is not None:
        copies = copies.join(_copy(also, key, keyed), [key, _SLICE], "left")
    rows = _cut(right, key, keyed, spread).withColumn("_match", F.lit(True))
    joined = copies.join(rows, [key, _SLICE], "left")
    return joined.filter(F.col("_match") | F.col(_SLICES).isNull()).drop(_SLICE, _SLICES, "_match")

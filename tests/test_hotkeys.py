"""Joins with keys that hold a large part of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.operators.hotkeys import attach, expand, heavy_keys, hot_keys, none_heavy

ROWS = 4000


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows have key 7, a third none, the others keys of their own."""
    key = F.expr("case id % 3 when 0 then 7L when 1 then null else id + 1000 end")
    return spark.range(ROWS).select(F.col("id").alias("row"), key.alias("key"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.sql("select 7L as key, 'hot' as name union all select id, 'cold' from range(1000, 3000)")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_finds_hot_keys(facts):
    found = hot_keys(facts, "key", "row")
    assert set(found["key"]) == {7, None}
    assert found["row"] == {}
    assert all(n >= 2 for n in found["key"].values())


def test_none_heavy(spark, facts):
    """Proved for even keys with light rows only; a key with many rows or heavy ones is not ruled out."""
    even = spark.range(ROWS).selectExpr("id % 400 as key")
    assert none_heavy(even, "key", 2)
    assert not none_heavy(even, "key", 200)
    assert not none_heavy(facts, "key", 1)
    assert not none_heavy(even, "key", 1_000_000)
    assert none_heavy(even.limit(0), "key", 2)


def test_heavy_keys(spark):
    weights = spark.sql("select id as key, if(id = 3, 1000, 1) as weight from range(100)")
    assert set(heavy_keys(weights, "key", "weight")) == {3}
    assert heavy_keys(weights.limit(0), "key", "weight") == {}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [{}, {7: 4}, {None: 3}, {7: 4, None: 3}, {1001: 2, 7: 1}])
def test_attach_equals_join(facts, lookup, hot, how):
    joined = attach(facts, lookup, "key", hot, ["row"], how)
    assert joined.columns == ["key", "row", "name"]
    assert same(joined, facts.join(lookup, "key", how))


def test_attach_with_repeated_right_rows(facts, lookup):
    twice = lookup.union(lookup)
    joined = attach(facts, twice, "key", {7: 4, None: 3}, ["row"])
    assert same(joined, facts.join(twice, "key", "left"))


@pytest.mark.parametrize("hot", [{}, {7: 4}, {7: 400}, {7: 4, None: 3}])
def test_expand_equals_join(spark, facts, lookup, hot):
    left = lookup.union(spark.sql("select 5L, 'no match' union all select null, 'no key'"))
    joined = expand(left, facts, "key", hot, ["row"])
    assert joined.columns == ["key", "name", "row"]
    assert same(joined, left.join(facts, "key", "left"))


@pytest.mark.parametrize("hot", [{}, {7: 4}, {7: 4, None: 3}])
def test_expand_with_one_more_table(spark, facts, lookup, hot):
    """A table with a row per key is joined in the same slices, on one shuffle of the left side."""
    left = lookup.union(spark.sql("select 5L, 'no match' union all select null, 'no key'"))
    also = spark.sql("select id as key, id * 2 as total from range(0, 2000, 7)").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = expand(left, facts, "key", hot, ["row"], also)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(key") == 3
        assert same(joined, left.join(also, "key", "left").join(facts, "key", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slices_spread_a_hot_key(spark, facts, lookup):
    """Without slices one task gets all rows of the key; with them none gets the most of it."""
    quiet = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in quiet}
    try:
        for k, v in quiet.items():
            spark.conf.set(k, v)

        def largest(joined):
            sizes = joined.groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count")).first()[0]

        plain = largest(facts.join(lookup, "key", "left"))
        hot = hot_keys(facts, "key")["key"]
        sliced = largest(attach(facts, lookup, "key", hot, ["row"]))
        assert plain >= ROWS / 3
        assert sliced < plain / 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

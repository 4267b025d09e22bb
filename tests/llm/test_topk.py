import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import topk

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("v", T.StringType()),
        T.StructField("shard", T.IntegerType()),
    ]
)


def expected(rows, k):
    good = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, v) in enumerate(good):
        if q is None or q % 50:
            continue
        scores = [
            (-sum(a * b for a, b in zip(v, w)), i is None, i or 0)
            for other, (i, w) in enumerate(good)
            if other != at and len(w) == len(v)
        ]
        best = sorted(scores)[:k]
        out += [(q, n, None if none else i, -s) for n, (s, none, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def check(spark, rows, **sizes):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = topk.top_k(table, F.col("vec_id") % 50 == 0, 5, **sizes).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, 5)


def vectors(n, width=6, grid=8):
    rng = random.Random(n)
    return [(i, [rng.randrange(-grid, grid) / 8 for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"shard": 60, "block": 3}])
def test_against_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "LEAF", 8)
    check(spark, vectors(400), **sizes)


def test_ties_and_one_common_vector(spark):
    rows = vectors(150, width=2, grid=2) + [(1000 + i, [1.0, 1.0]) for i in range(120)]
    check(spark, rows, shard=50)


def test_awkward_rows(spark):
    rows = vectors(30) + [
        (100, None), (150, []), (200, []), (250, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
        (300, [math.nan] * 6), (350, [math.inf] * 6), (400, [0.5]), (None, [1.0] * 6), (None, [1.0] * 6),
        (50, [1.0] * 6), (50, [1.0] * 6), (50, [-1.0] * 6), (450, [1e30] * 2),
    ]
    check(spark, rows)


@pytest.mark.parametrize("large", [1e30, 1e17, 3e7])
def test_scores_beyond_64_bits_are_refused(spark, large):
    table = spark.createDataFrame([(50, [large] * 3, "x", 1), (51, [large] * 3, "x", 1)], SCHEMA)
    with pytest.raises(ArithmeticError, match="64 bits"):
        topk.top_k(table, F.col("vec_id") % 50 == 0, 5)


def test_empty_table(spark):
    check(spark, [])


def test_large_components_are_scored_in_integers(spark):
    check(spark, [(50 * i, [float(2**18 + i), float(2**17), 1.0]) for i in range(20)])


def test_rows_of_one_id_and_without_spread_over_shards(spark):
    rows = vectors(300, grid=1000)
    rows = [(50 if i % 3 == 0 else None if i % 3 == 1 else i, v) for i, v in rows]
    table = spark.createDataFrame(rows, "vec_id long, v array<double>")
    table = table.select(F.coalesce("vec_id", F.lit(int(topk.NO_ID))).alias("vec_id"), topk.whole(F.col("v")).alias("v"))
    sizes = [r["count"] for r in table.groupBy(topk.home_shard(10).alias("shard")).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 60
    check(spark, rows, shard=30, block=20)

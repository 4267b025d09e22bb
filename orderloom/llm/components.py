"""Connected components of a graph given as edges, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.shared import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node with an edge; root is the smallest node it is connected with.

    `edges` has columns a and b. Large-star and small-star steps alternate until every node hangs
    on its root; each round is written to the shared folder, so lineage stays short. A round has
    no more edges than the one before.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = keep(edges.select(high.alias("u"), low.alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        large = keep(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        now = keep(small, "small")
        sums = now.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if before == tuple(sums):
            break
        before = tuple(sums)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""Exact top-k search by inner product: a KD-tree per shard, searched best first.

Vectors are dealt to shards by their ids and components, so rows of one id, or without any, spread
too. Each shard's tree is split at medians and has tight boxes. A query visits boxes in the order
of the largest inner product a box allows, and stops at the first box that cannot better its k-th
score. The k-th score found in the query's home shard is handed on to all other shards as a bound,
so that there only better boxes are opened. Queries go to shards in blocks, so a task holds one
shard and one block whatever the table's size.

Components are whole numbers. Scores and bounds are computed in double precision, which is exact
below 2^53; a shard with larger possible scores is scored in 64-bit integers without bounds. If
vectors that are compared could have scores of 2^63 or more, an ArithmeticError says so at once.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors
are compared with vectors of their length only; a row with a null id is a candidate, behind equal
scores with ids, and never a query; of repeated rows each is a candidate of its own, and each
query row has its own result (one of its copies is left out as itself).
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderloom.sources.shared import keep

SHARD = 8192
BLOCK = 4096
LEAF = 128
NO_ID = np.iinfo(np.int64).max
EXACT = float(2**53)


class Tree:
    def __init__(self, points: np.ndarray, ids: np.ndarray, copies: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.low, self.high, self.least, self.span, self.below = [], [], [], [], []
        todo = [(0, len(ids), -1)]
        while todo:
            start, end, parent = todo.pop()
            node = len(self.span)
            inside = points[order[start:end]]
            self.low.append(inside.min(0))
            self.high.append(inside.max(0))
            self.least.append(int(ids[order[start:end]].min()))
            self.span.append((start, end))
            self.below.append([])
            if parent >= 0:
                self.below[parent].append(node)
            if end - start > leaf:
                axis = int(np.argmax(self.high[-1] - self.low[-1])) if points.shape[1] else 0
                middle = (end - start) // 2
                if points.shape[1]:
                    split = np.argpartition(inside[:, axis], middle)
                    order[start:end] = order[start:end][split]
                todo += [(start, start + middle, node), (start + middle, end, node)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.points, self.ids, self.copies = points[order], ids[order], copies[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product each box allows, queries x boxes."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def search(
    tree: Tree, query: np.ndarray, bounds: np.ndarray, own: int, same: int, k: int, floor: float
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows of a tree that score at least `floor`.

    `own` is the query's id; one copy of the row with that id and the vector itself is left out
    (`same` tells whether the tree may hold it).
    """
    scores, ids = np.zeros(0, tree.points.dtype), np.zeros(0, np.int64)
    worst, last = floor, NO_ID
    heap = [(-bounds[0], tree.least[0], 0)]
    while heap:
        bound, least, node = heapq.heappop(heap)
        if -bound < worst or (-bound == worst and len(ids) == k and least > last):
            break
        if tree.below[node]:
            for x in tree.below[node]:
                heapq.heappush(heap, (-bounds[x], tree.least[x], x))
            continue
        start, end = tree.span[node]
        found = tree.points[start:end] @ query
        better = np.flatnonzero(found >= worst)
        if not len(better):
            continue
        copies = np.minimum(tree.copies[start:end][better], k + 1)
        if same:
            me = tree.ids[start:end][better] == own
            if me.any():
                me &= (tree.points[start:end][better] == query).all(1)
                copies = np.where(me, np.minimum(tree.copies[start:end][better] - 1, k), copies)
        scores = np.concatenate([scores, np.repeat(found[better], copies)])
        ids = np.concatenate([ids, np.repeat(tree.ids[start:end][better], copies)])
        best = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[best], ids[best]
        if len(ids) == k:
            worst, last = max(floor, scores[-1]), ids[-1]
    return scores, ids


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    values = column.combine_chunks()
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(values), width)


def search_shard(vectors: pa.Table, queries: pa.Table, width: int, k: int) -> pa.Table:
    points, asked = matrix(vectors["v"], width), matrix(queries["v"], width)
    ids = vectors["vec_id"].to_numpy()
    tree = Tree(points, ids, vectors["copies"].to_numpy())
    largest = float(np.abs(points).max(initial=0)) * float(np.abs(asked).max(initial=0)) * width
    if largest < EXACT:
        tree.points, asked = tree.points.astype(float), asked.astype(float)
        bounds = tree.bounds(asked)
    else:
        bounds = np.full((len(asked), len(tree.span)), np.inf)
    out = {"query_id": [], "variant": [], "vec_id": [], "score": []}
    own, variant, floors = (queries[c].to_numpy() for c in ("vec_id", "variant", "bound"))
    for q in range(len(asked)):
        scores, found = search(tree, asked[q], bounds[q], int(own[q]), True, k, floors[q])
        out["query_id"].append(np.full(len(found), own[q]))
        out["variant"].append(np.full(len(found), variant[q]))
        out["vec_id"].append(found)
        out["score"].append(scores.astype(np.int64))
    return pa.table({name: np.concatenate(x).astype(np.int64) for name, x in out.items()})


def whole(vector: Column) -> Column:
    """Components x as floor(256 * x); null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(
        vector.isNotNull() & ~bad,
        F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double"))),
    )


def check_range(rows: DataFrame) -> None:
    """Raise if two of the rows (v, copies, is_query) could have a score that 64 bits don't hold."""
    peak = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    widths = rows.groupBy(F.size("v").alias("width")).agg(
        F.max(peak).alias("peak"), F.sum("copies").alias("rows"), F.max("is_query").alias("asked")
    )
    compared = widths.filter("rows > 1 and asked")
    largest = compared.agg(F.max(F.col("width") * F.col("peak") * F.col("peak"))).first()[0]
    if largest is not None and largest >= 2.0**63:
        raise ArithmeticError(f"scores may reach {largest:.3g}, which 64 bits don't hold")


def home_shard(shards: int) -> Column:
    """The shard of a row (vec_id, v). Rows that are distinct in both spread, whatever their ids."""
    return F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")


def top_k(
    table: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k other rows with the largest inner products.

    `is_query` is a condition on the id, as column vec_id.
    """
    rows = (
        table.select(F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col)).alias("v"))
        .filter("v is not null")
        .groupBy("vec_id", "v")
        .agg(F.count("*").alias("copies"))
        .withColumn("is_query", F.coalesce(is_query, F.lit(False)))
        .withColumn("vec_id", F.coalesce("vec_id", F.lit(int(NO_ID))))
    )
    rows = keep(rows, "vectors")
    check_range(rows)
    n = rows.agg(F.count("*").alias("rows"), F.sum(F.col("is_query").cast("long")).alias("queries")).first()
    shards = max(1, -(-n["rows"] // shard))
    blocks = max(1, -(-(n["queries"] or 0) // block))

    key = ["width", "shard", "block"]
    rows = rows.select(
        "*",
        F.size("v").alias("width"),
        home_shard(shards).alias("shard"),
        F.xxhash64("v").alias("variant"),
    )
    queries = rows.filter("is_query")
    schema = "query_id long, variant long, vec_id long, score long"

    def run(vectors: DataFrame, asked: DataFrame) -> DataFrame:
        def one(at: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            if not (left.num_rows and right.num_rows):
                return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "variant", "vec_id", "score")})
            return search_shard(left, right, at[0].as_py(), k)

        left = vectors.select(*key, "vec_id", "v", "copies").groupBy(*key)
        # Both sides come from one table: renaming gives this one columns of its own.
        right = asked.select(*key, "vec_id", "v", "variant", "bound")
        right = right.toDF(*right.columns).groupBy(*key)
        return left.cogroup(right).applyInArrow(one, schema)

    low = F.lit(float("-inf"))
    at_home = queries.withColumns({"block": F.lit(0), "bound": low})
    home = keep(run(rows.withColumn("block", F.lit(0)), at_home), "home")
    found = home
    if shards > 1:
        kth = home.groupBy("query_id", "variant").agg(
            F.when(F.count("*") >= k, F.min("score")).cast("double").alias("bound")
        )
        asked = (
            queries.join(kth.withColumnRenamed("query_id", "vec_id"), ["vec_id", "variant"], "left")
            .withColumn("bound", F.coalesce("bound", low))
            .withColumn("block", F.pmod(F.xxhash64("variant", "vec_id"), F.lit(blocks)).cast("int"))
            .withColumnRenamed("shard", "home")
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .filter("shard <> home")
        )
        vectors = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        found = home.unionByName(run(vectors, asked))
    best = W.partitionBy("query_id", "variant").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    times = queries.select(F.col("vec_id").alias("query_id"), "variant", "copies").filter("copies > 1")
    return (
        ranked.join(times, ["query_id", "variant"], "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long")))))
        .select(
            "query_id",
            "rank",
            F.when(F.col("vec_id") != int(NO_ID), F.col("vec_id")).alias("vec_id"),
            "score",
        )
    )

"""SimHash near-duplicates: 64-bit fingerprints, all pairs within a few bits compared in tiles.

Fingerprints are made distinct, gathered into blocks by population count, and every pair of
blocks that can hold a link is compared by one task, in tiles, with numpy exclusive-or and bit
counts. A pair of tiles is skipped if population counts (of the four quarters of a fingerprint)
differ by more than the radius in sum. A task hands on a spanning forest of the links it found,
never all pairs, and the components are joined up by Spark.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked
like any other; a document with a null id takes part, but is never the smallest id of its
component (null if all ids are); repeated rows keep their number; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import fresh, id_and_text, map_texts
from orderloom.llm.components import components
from orderloom.sources.shared import keep

SHINGLE = 4
RADIUS = 4
TILE = 256
CHUNK = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n], ends[len(words) - n :]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        places = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        h = np.array([digest(joined[a:b], 42) for a, b in places], np.dtype("<u8"))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) of every row."""

    def run(texts: list[str]) -> list:
        found = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return [found.view(np.int64)]

    return map_texts(id_and_text(docs), run, [("fp", pa.int64(), T.LongType())])


def quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


class Tiles:
    """Distinct fingerprints in an order that keeps alike population counts together."""

    def __init__(self, fps: np.ndarray):
        counts = quarters(fps)
        order = np.lexsort([*counts.T[::-1], counts[:, :2].sum(1), counts.sum(1)])
        self.fps, counts = fps[order], counts[order]
        starts = np.arange(0, len(fps), TILE)
        self.low = np.minimum.reduceat(counts, starts) if len(fps) else counts
        self.high = np.maximum.reduceat(counts, starts) if len(fps) else counts
        total = counts.sum(1)
        self.least = np.minimum.reduceat(total, starts) if len(fps) else total
        self.most = np.maximum.reduceat(total, starts) if len(fps) else total

    def near(self, i: int, other: Tiles, radius: int) -> np.ndarray:
        """Tiles of the other side that may hold a link with tile i."""
        gap = np.maximum(0, np.maximum(other.low - self.high[i], self.low[i] - other.high)).sum(1)
        whole = np.maximum(other.least - self.most[i], self.least[i] - other.most)
        return np.flatnonzero((gap <= radius) & (whole <= radius))


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of i and j pairwise; every node of `parent` points at its root."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks (or within one) as a spanning forest of pairs of fingerprints."""
    a = Tiles(left)
    b = a if right is None else Tiles(right)
    shift = 0 if right is None else len(a.fps)
    parent = np.arange(shift + len(b.fps), dtype=np.int64)
    for i in range(len(a.low)):
        rows = a.fps[i * TILE : (i + 1) * TILE]
        for j in a.near(i, b, radius):
            if right is None and j < i:
                continue
            cols = b.fps[j * TILE : (j + 1) * TILE]
            x, y = np.nonzero(np.bitwise_count(rows[:, None] ^ cols[None, :]) <= radius)
            if len(x):
                unite(parent, x + i * TILE, y + j * TILE + shift)
    every = a.fps if right is None else np.concatenate([a.fps, b.fps])
    hung = np.flatnonzero(parent != np.arange(len(parent)))
    return every[hung], every[parent[hung]]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect just the fingerprints linked within `radius` bits, directly or not.

    `distinct` has one row per fingerprint, column fp.
    """
    population = distinct.withColumn("ones", F.bit_count("fp").cast("int"))
    sizes = {r["ones"]: r["n"] for r in population.groupBy("ones").agg(F.count("*").alias("n")).collect()}
    block = min(65536, max(4096, sum(sizes.values()) // 24))
    bands: list[list[int]] = []  # lowest and highest population count, rows
    for ones in sorted(sizes):
        if bands and bands[-1][2] + sizes[ones] <= block:
            bands[-1][1:] = [ones, bands[-1][2] + sizes[ones]]
        else:
            bands.append([ones, ones, sizes[ones]])
    parts = [-(-n // block) for _, _, n in bands]
    unit = F.lit(None)
    base = 0
    near: list[tuple[int, int, int, int]] = []
    for k, (low, high, _) in enumerate(bands):
        inside = (F.col("ones") >= low) & (F.col("ones") <= high)
        number = F.lit(base) + F.pmod(F.xxhash64("fp"), F.lit(parts[k])).cast("int")
        unit = number if k == 0 else F.when(inside, number).otherwise(unit)
        near.append((base, base + parts[k], low, high))
        base += parts[k]
    # Bands are few (65 at most); each unit is paired with the units of its own and near bands.
    partners = F.lit(None).cast("array<int>")
    for first, last, low, high in near:
        reach = [n for n in near if n[2] <= high + radius and n[3] >= low - radius]
        others = F.sequence(F.lit(min(n[0] for n in reach)), F.lit(max(n[1] for n in reach) - 1))
        partners = F.when(F.col("unit").between(first, last - 1), others).otherwise(partners)
    if not near:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    blocks = (
        population.select("fp", unit.cast("int").alias("unit"))
        .groupBy("unit")
        .agg(F.collect_list("fp").alias("fps"))
        .select("unit", "fps", F.explode(partners).alias("other"))
        .select(
            F.least("unit", "other").alias("u"),
            F.greatest("unit", "other").alias("v"),
            (F.col("unit") > F.col("other")).alias("second"),
            "fps",
        )
    )

    def compare(table: pa.Table) -> pa.Table:
        sides = {}
        for row in range(table.num_rows):
            fps = table.column("fps").chunk(0)[row].values.to_numpy(zero_copy_only=False)
            sides[table.column("second")[row].as_py()] = fps.view(np.uint64)
        a, b = forest(sides[False], sides.get(True), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    def one(key: tuple, tables: pa.Table) -> pa.Table:
        return compare(tables.combine_chunks())

    return blocks.groupBy("u", "v").applyInArrow(one, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp, root (smallest fp of the component), component_id."""
    every = keep(fingerprints(docs, shingle), "fingerprints")
    distinct = every.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return every.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs`, one of each component: that with the smallest id (nulls last)."""
    name, of, key = fresh(docs.columns, "mark", "of", "key")
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    marked = docs.withColumn(name, mark)
    every = map_marked(marked.select("doc_id", "text", F.col(name).alias("mark")), shingle)
    every = keep(every, "fingerprints")
    distinct = every.select("fp").distinct()
    found = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("mark"))
    chosen = (
        every.groupBy("fp")
        .agg(F.min(rank).alias("rank"))
        .join(found, "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("rank").alias("rank"))
        .select(F.col("rank.doc_id").alias(of), F.col("rank.mark").alias(key))
    )
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(name) == F.col(key))
    kept = marked.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["doc_id", name]).select(*docs.columns)


def map_marked(marked: DataFrame, shingle: int) -> DataFrame:
    """doc_id, mark and fp of every row of a frame with columns doc_id, text and mark."""
    schema = T.StructType(
        [
            T.StructField("doc_id", marked.schema["doc_id"].dataType),
            T.StructField("mark", T.LongType()),
            T.StructField("fp", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = np.array([fingerprint(t.as_py() or "", shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(found.view(np.int64))],
                names=["doc_id", "mark", "fp"],
            )

    return marked.select("doc_id", "text", "mark").mapInArrow(run, schema)

"""Ranked lexical search: bit-sliced Bloom signatures bound the scores, the rest is scored exactly.

Documents are gathered into blocks of alike numbers of distinct terms. A block's signature is a
matrix of bits with a column per document: each term sets a few rows, chosen by its hash, and a term
that occurs 2, 4, 8, ... times sets further rows, one set per level of occurrence. The rows of a
term and level, taken together by bitwise and, are a slice: a bit map of the documents that may
have the term that often. It never misses one, so per document

    sum over levels of (gain of the level x sum of the weights of the terms whose slice has it)

is no less than the score. Documents are scored exactly, best bound first, from the block's list of
terms and occurrences, until the bounds fall below the score of the last rank so far; all others
are provably outside. A few blocks are searched first, and the scores they give start the search in
all others, so a task hands on little.

The index has a row per block. It is made in one pass over the documents, which need no shuffle, and
knows everything else the scores need: the number of documents that have each term, and all lengths.
Queries are taken in blocks of bounded size.

Defined cases: a null or empty text, or one without a term, takes no part; repeated rows are
documents of their own; of equal scores the smaller doc_id comes first, a null one last; an item
without terms has no result, a repeated item has its results as often; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import id_and_text, id_type, plain_words, slices
from orderloom.sources.shared import keep

TOP = 50
# Documents of a block at most, and (document, term) pairs after which it is full.
DOCS, PAIRS = 1024, 1 << 18
# Rows a term sets in a signature, and rows a signature has for each term of its largest document.
HASHES, SPARE = 3, 8
# Occurrences from which a term is on each level.
LEVELS = (1, 2, 4, 8, 16, 64)
# One block in so many is searched first.
FIRST = 32
# Bytes of items that are searched for together.
ITEM_BYTES = 4 << 20
RESCORED = 256

BLOBS = ("words", "df", "bits", "per_doc", "terms", "times")


def hashes(terms: list[bytes]) -> np.ndarray:
    """64 bits per term and row it sets, for its first level."""
    pairs = [(zlib.crc32(t), zlib.adler32(t[::-1])) for t in terms]
    h = np.array(pairs, np.uint64).reshape(-1, 2)
    x = h[:, 0] << np.uint64(32) | h[:, 1]
    return mixed(x[:, None] + np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def rows_of(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """The signature rows of terms on a level; `size` is a power of two."""
    return (mixed(h + np.uint64(level)) & np.uint64(size - 1)).astype(np.int64)


class Block:
    """Documents not yet indexed, all of one size class; terms are held as places in a list."""

    def __init__(self) -> None:
        self.ids: list = []
        self.place: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.pairs = 0

    def add(self, doc_id: object, counts: Counter) -> bool:
        """Whether the block is full with this document."""
        place, n = self.place, len(counts)
        self.ids.append(doc_id)
        self.terms.append(np.fromiter((place.setdefault(t, len(place)) for t in counts), np.int32, n))
        self.times.append(np.fromiter(counts.values(), np.int32, n))
        self.pairs += n
        return len(self.ids) == DOCS or self.pairs >= PAIRS


def signed(terms: np.ndarray, times: np.ndarray, docs: np.ndarray, h: np.ndarray, n: int) -> tuple[int, bytes]:
    """Rows of the signature of (term, times, document) triples, and its bits."""
    most = int(np.bincount(docs).max())
    size = 1 << max(6, (SPARE * most - 1).bit_length())
    bits = np.zeros((size, n), bool)
    for level, least in enumerate(LEVELS):
        on = times >= least
        if not on.any():
            break
        rows = rows_of(h[terms[on]], level, size)
        for k in range(HASHES):
            bits[rows[:, k], docs[on]] = True
    return size, np.packbits(bits, axis=1).tobytes()


def packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def unpacked(data: bytes, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def words_of(row: dict) -> list[bytes]:
    """The vocabulary of a block, in order."""
    return zlib.decompress(row["words"]).split()


def indexed(block: Block) -> dict:
    """A row of the index: see `index`."""
    vocabulary = list(block.place)
    sizes = np.array([len(t) for t in block.terms], np.int32)
    terms, times = np.concatenate(block.terms), np.concatenate(block.times)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    size, bits = signed(terms, times, docs, hashes(vocabulary), len(sizes))
    return {
        "ids": block.ids,
        "lengths": np.add.reduceat(times.astype(np.int64), np.cumsum(sizes) - sizes).tolist(),
        "words": zlib.compress(b" ".join(vocabulary), 1),
        "df": packed(np.bincount(terms, minlength=len(vocabulary)).astype(np.int32)),
        "size": size,
        "bits": bits,
        "per_doc": packed(sizes),
        "terms": packed(terms),
        "times": packed(times),
    }


def index(docs: DataFrame) -> DataFrame:
    """The index of the documents that have a term: a row per block.

    ids, lengths (all terms, with repeats) by document; words (the vocabulary, joined by spaces), df
    (documents of the block that have it) by term; size and bits of the signature; per_doc (distinct
    terms of each document), terms and times (each pair's place in the vocabulary, and occurrences).
    Numbers are 32-bit integers; all but the bits are compressed.
    """
    texts = id_and_text(docs)
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(id_type(docs))),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("size", T.LongType()),
        ]
        + [T.StructField(c, T.BinaryType()) for c in BLOBS]
    )
    kind = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    arrow = pa.schema(
        [("ids", pa.list_(kind)), ("lengths", pa.list_(pa.int64())), ("size", pa.int64())]
        + [(c, pa.binary()) for c in BLOBS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, Block] = {}
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    counts = Counter(plain_words(text.as_py()))
                    if not counts:
                        continue
                    of = len(counts).bit_length()
                    if open_.setdefault(of, Block()).add(doc_id, counts):
                        yield pa.RecordBatch.from_pylist([indexed(open_.pop(of))], arrow)
        for of in sorted(open_):
            yield pa.RecordBatch.from_pylist([indexed(open_[of])], arrow)

    return texts.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


class Queries:
    """Items, as lists of places in the list of their terms, with the weights of these."""

    def __init__(self, items: list[list[bytes]], df: dict[bytes, int], n: int):
        self.terms = sorted({t for item in items for t in item})
        place = {t: k for k, t in enumerate(self.terms)}
        self.items = [np.array(sorted(place[t] for t in set(item)), np.int64) for item in items]
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in self.terms]
        self.weights = np.array(weights, np.int64)
        self.hashes = hashes(self.terms)


def gain(times: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    """What a unit of weight gives for a term that occurs so often."""
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


def slices_of(queries: Queries, row: dict) -> list[np.ndarray]:
    """For each level a matrix of bits: documents (columns) that may have a term (row) that often."""
    n = len(row["ids"])
    bits = np.frombuffer(row["bits"], np.uint8).reshape(row["size"], -1)
    found = []
    for level in range(len(LEVELS)):
        rows = rows_of(queries.hashes, level, row["size"])
        some = bits[rows[:, 0]]
        for k in range(1, HASHES):
            some &= bits[rows[:, k]]
        if found:
            some &= found[-1]
        found.append(some)
        if not some.any():
            break
    return found if n else []


class Best:
    """The highest exact scores of an item so far."""

    def __init__(self, floor: int, top: int):
        self.floor, self.top = floor, top
        self.rows: list[tuple] = []

    def add(self, scores: np.ndarray, ids: list) -> None:
        rows = [(-s, i is None, i) for s, i in zip(scores.tolist(), ids) if s > 0 and s >= self.floor]
        if rows:
            # Null ids differ in nothing but their score.
            self.rows = sorted(self.rows + rows, key=lambda r: r[:2] + (() if r[1] else (r[2],)))[: self.top]
            if len(self.rows) == self.top:
                self.floor = max(self.floor, -self.rows[-1][0])


def search_block(queries: Queries, row: dict, n: int, total: int, best: list[Best]) -> int:
    """Add a block's documents to the best of each item; the number scored exactly."""
    ids, lengths = row["ids"], np.array(row["lengths"], np.int64)
    m = np.array([50 + 50 * length * n // total for length in lengths.tolist()], np.int64)
    maps = slices_of(queries, row)
    # The most a term of a level can give: the next level's occurrences less one.
    caps = [gain(least - 1, m) for least in LEVELS[1:]] + [np.full(len(ids), 1_000_000, np.int64)]
    steps = [caps[0]] + [b - a for a, b in zip(caps, caps[1:])]
    sizes = unpacked(row["per_doc"]).astype(np.int64)
    ends = np.cumsum(sizes)
    place = {t: k for k, t in enumerate(queries.terms)}
    known = np.array([place.get(t, -1) for t in words_of(row)], np.int64)
    # Each pair's term as a place among the queries' terms, -1 if in none.
    terms, times = known[unpacked(row["terms"])], unpacked(row["times"])
    weight = np.zeros(len(queries.terms) + 1, np.int64)
    scored = 0
    for item, mine in zip(queries.items, best):
        w = queries.weights[item].astype(np.float64)
        bound = np.zeros(len(ids), np.int64)
        for some, step in zip(maps, steps):
            # Sums of weights are whole and far below 2^53.
            sums = w @ np.unpackbits(some[item], axis=1, count=len(ids)).astype(np.float64)
            bound += step * sums.astype(np.int64)
        likely = np.flatnonzero((bound > 0) & (bound >= mine.floor))
        likely = likely[np.argsort(-bound[likely], kind="stable")]
        weight[item] = queries.weights[item]
        for at in range(0, len(likely), RESCORED):
            docs = likely[at : at + RESCORED]
            docs = docs[bound[docs] >= mine.floor]
            if not len(docs):
                break
            scored += len(docs)
            count = sizes[docs]
            first = np.cumsum(count) - count
            pairs = np.arange(count.sum()) + np.repeat(ends[docs] - count - first, count)
            k = times[pairs].astype(np.int64)
            part = weight[terms[pairs]] * gain(k, np.repeat(m[docs], count))
            mine.add(np.add.reduceat(part, first), [ids[d] for d in docs.tolist()])
        weight[item] = 0
    return scored


def best_of(
    blocks: DataFrame, queries: Queries, floors: list[int], n: int, total: int, top: int, kind: T.DataType
) -> DataFrame:
    """item, doc_id, score: candidates for the first `top` of each item, from each task."""
    schema = T.StructType(
        [T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(floor, top) for floor in floors]
        some = None
        for batch in batches:
            some = batch.schema.field("ids").type.value_type
            for k in range(batch.num_rows):
                search_block(queries, batch.slice(k, 1).to_pylist()[0], n, total, best)
        if some is None:
            return
        rows = [(k, r[2], -r[0]) for k, b in enumerate(best) for r in b.rows]
        columns = list(zip(*rows)) or [(), (), ()]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), some, pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return blocks.mapInArrow(run, schema)


def ranked(rows: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= top)


def item_blocks(items: DataFrame) -> Iterator[list]:
    """The distinct items with a term, in blocks of about ITEM_BYTES: rows item_id, text, copies."""
    distinct = (
        items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .groupBy("item_id", "text")
        .agg(F.count("*").alias("copies"))
    )
    size = distinct.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-size // ITEM_BYTES))
    distinct = distinct.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    for part in range(parts):
        rows = distinct.filter(F.col("part") == part).drop("part").collect()
        if rows:
            yield sorted(rows, key=lambda r: (r["text"], str(r["item_id"])))


def frequencies(blocks: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """The number of documents that have each of the terms, those of one block of items."""
    place = {t: k for k, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                known = np.array([place.get(t, -1) for t in words_of(row)], np.int64)
                counts[known[known >= 0]] += unpacked(row["df"])[known >= 0]
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["term", "df"])

    found = blocks.select("words", "df").mapInArrow(run, "term long, df long")
    return {terms[r["term"]]: r["df"] for r in found.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def search(blocks: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of the index for each item (item_id, text)."""
    spark = blocks.sparkSession
    kind = blocks.schema["ids"].dataType.elementType
    name = items.schema["item_id"]
    schema = T.StructType(
        [T.StructField("item_id", name.dataType), T.StructField("rank", T.IntegerType()),
         T.StructField("doc_id", kind), T.StructField("score", T.LongType())]
    )
    sums = blocks.agg(
        F.sum(F.size("ids")).cast("long").alias("n"),
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total"),
    ).first()
    result = spark.createDataFrame([], schema)
    if not sums["n"]:
        return result
    n, total = int(sums["n"]), int(sums["total"])
    for rows in item_blocks(items):
        texts = [plain_words(r["text"]) for r in rows]
        terms = sorted({t for text in texts for t in text})
        queries = Queries(texts, frequencies(blocks, terms), n)
        first = best_of(
            blocks.filter(F.pmod(F.xxhash64("block"), F.lit(FIRST)) == 0), queries, [1] * len(rows), n, total, top, kind
        )
        # One number per item of the block: the last rank's score, of the items that have so many.
        floors = [1] * len(rows)
        for r in ranked(first, top).filter(F.col("rank") == top).select("item", "score").collect():
            floors[r["item"]] = max(1, r["score"])
        found = ranked(best_of(blocks, queries, floors, n, total, top, kind), top)
        names = T.StructType(
            [T.StructField("item", T.IntegerType()), T.StructField("item_id", name.dataType),
             T.StructField("copies", T.LongType())]
        )
        numbered = spark.createDataFrame([(k, r["item_id"], r["copies"]) for k, r in enumerate(rows)], names)
        every = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        found = found.join(numbered, "item").withColumn("copy", every)
        result = result.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return result


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Index the documents, keep the index, and search it."""
    return search(keep(index(docs), "signatures"), items, top)


# In one word per document and term; the plain form of the scores.
ORACLE = """
    WITH words AS (
        SELECT row_number() OVER () AS doc, doc_id,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
        FROM documents WHERE text IS NOT NULL),
    docs AS (SELECT doc, doc_id, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0),
    sums AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
    every AS (SELECT doc, unnest(terms) AS term FROM docs),
    counts AS (SELECT doc, term, count(*)::BIGINT AS tf FROM every GROUP BY doc, term),
    found AS (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term),
    asked AS (
        SELECT DISTINCT item, item_id, term FROM (
            SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark)),
    weighed AS (
        SELECT item, item_id, term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
        FROM asked JOIN found USING (term) CROSS JOIN sums),
    scored AS (
        SELECT item, item_id, doc, doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM weighed JOIN counts USING (term) JOIN docs USING (doc) CROSS JOIN sums
        GROUP BY item, item_id, doc, doc_id),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
        FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 50"""

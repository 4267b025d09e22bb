"""I-Match fingerprints: hashes of a text's terms from several random parts of a lexicon.

The lexicon holds the terms whose inverse document frequency lies in a band: terms of more than
half of the documents say little, terms of fewer than one document in ten thousand are chance.
Near copies of one text may hold a third of the table, so the band ends above that.
Frequencies are counted over all documents. As the documents' distinct terms are shared out among
the lexicon's terms, it has at most `RAREST` times the mean number of distinct terms of a
document; tasks get it as a bit map of fixed size over hashed terms.

A text's terms from the lexicon are made distinct, sorted (by hash) and hashed: all together, and
those in each of random subsets of the lexicon, large ones for short texts and small ones for long
texts. The smallest subsets go on being cut to a quarter, level by level, until none holds a term
of the text, so however long a text is, some level has few terms to a subset. The likeness of two fingerprints is the share of equal hashes among the
subsets of a size that hold a term of either text, for the size that shows most.

Defined cases: a text without terms from the lexicon is hashed whole, and is like another only if
both have the same words; a null or empty text has no words; the next document of a repeated id
is the next row by text hash; ids that are text are ordered as text; null ids come last; the last document's next is the first.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import id_and_text, id_type, map_texts, plain_words, slices

# The band, as shares of the documents: one in COMMONEST to one in RAREST.
COMMONEST = 2
RAREST = 10_000
MAP_BITS = 24
# Subsets hold one in so many of the lexicon's terms, for texts of different lengths.
LEVELS = {4: 8, 16: 8, 64: 12, 256: 12}
SHARES = tuple(share for share, n in LEVELS.items() for _ in range(n))
# Further levels hold one in STEP of the terms of the last of these.
STEP = 4
# Subsets of a level that must hold a term before the level counts.
ENOUGH = 3
CACHE_WORDS = 500_000
# Ranges of ids for each shuffle partition.
RANGES = 16

SALTS = np.array([xxhash.xxh64_intdigest(b"subset", k) | 1 for k in range(len(SHARES))], np.uint64)
LIMITS = np.array([(1 << 64) // s - 1 for s in SHARES], np.uint64)


def term_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def frequencies(docs: DataFrame) -> DataFrame:
    """term (hash) and n, the number of documents that hold it, counted in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def emit() -> pa.RecordBatch:
            hashes = np.array([term_hash(w) for w in counts], np.uint64).view(np.int64)
            n = np.fromiter(counts.values(), np.int64, len(counts))
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], names=["term", "n"])

        for batch in batches:
            for text in batch.column("text"):
                counts.update(set(plain_words(text.as_py())))
                if len(counts) > CACHE_WORDS:
                    yield emit()
                    counts.clear()
        yield emit()

    parts = id_and_text(docs).select("text").mapInArrow(run, "term long, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame) -> bytes:
    """The bit map of the lexicon's hashed terms: 2^MAP_BITS bits, whatever the data."""
    rows = docs.count()
    band = frequencies(docs).filter(
        (F.col("n") * COMMONEST <= F.lit(max(rows, COMMONEST))) & (F.col("n") * RAREST >= F.lit(rows))
    )
    place = F.shiftrightunsigned("term", 64 - MAP_BITS)
    # One row per 32 bits of the map at most, so no more than 2^19 rows.
    words = band.groupBy(F.shiftright(place, 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(term, {64 - MAP_BITS}) & 31 as int))")).alias("bits")
    )
    found = words.toArrow()
    bits = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return bits.tobytes()


def subset_hash(terms: np.ndarray) -> str:
    return xxhash.xxh32_hexdigest(terms.tobytes()) if len(terms) else "0" * 8


class Fingerprinter:
    def __init__(self, bit_map: bytes):
        self.bits = np.frombuffer(bit_map, np.uint32)
        self.known: dict[bytes, int] = {}

    def hashes(self, words: set[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in words.difference(known):
            known[word] = term_hash(word)
        return np.fromiter((known[w] for w in words), np.uint64, len(words))

    def fingerprint(self, text: str) -> str:
        words = plain_words(text)
        terms = self.hashes(set(words))
        place = terms >> np.uint64(64 - MAP_BITS)
        inside = self.bits[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32) & 1
        terms = np.sort(terms[inside.astype(bool)])
        if not len(terms):
            return xxhash.xxh64_hexdigest(b" ".join(words)) + "0" * 8 * len(SHARES)
        mixed = terms[:, None] * SALTS[None, :]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        chosen = mixed <= LIMITS[None, :]
        parts = [xxhash.xxh64_hexdigest(terms.tobytes())]
        for k in range(len(SHARES)):
            own = terms[chosen[:, k]]
            parts.append(subset_hash(own))
        last = range(len(SHARES) - list(LEVELS.values())[-1], len(SHARES))
        left = [(terms[chosen[:, k]], mixed[chosen[:, k], k]) for k in last]
        limit = int(LIMITS[-1]) // STEP
        while limit:
            left = [(own[at <= limit], at[at <= limit]) if len(own) else (own, at) for own, at in left]
            if not any(len(own) for own, _ in left):
                break
            parts += [subset_hash(own) for own, _ in left]
            limit //= STEP
        return "".join(parts)


def likeness(a: str, b: str) -> float:
    """The largest share, over the subset sizes, of equal hashes among subsets with a term."""
    if a == b:
        return 1.0
    empty = "0" * 8
    # Levels that a fingerprint doesn't go down to are empty.
    length = max(len(a), len(b))
    a, b = a.ljust(length, "0"), b.ljust(length, "0")
    at, best, same, every = 16, 0.0, 0, 0
    sizes = list(LEVELS.values())
    deeper = (length - 16 - 8 * sum(sizes)) // (8 * sizes[-1])
    for n in sizes + [sizes[-1]] * deeper:
        pairs = [(a[k : k + 8], b[k : k + 8]) for k in range(at, at + 8 * n, 8)]
        filled = sum(p != (empty, empty) for p in pairs)
        equal = sum(x == y != empty for x, y in pairs)
        if filled >= ENOUGH:
            best = max(best, equal / filled)
        same, every, at = same + equal, every + filled, at + 8 * n
    return best or (same / every if every else 0.0)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""
    bit_map = lexicon(docs)

    def run(texts: list[str]) -> list:
        maker = Fingerprinter(bit_map)
        return [[maker.fingerprint(t) for t in texts]]

    return map_texts(id_and_text(docs), run, [("fingerprint", pa.string(), T.StringType())])


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, role, doc_id, text), sorted so that a row's successor in descending id order
    follows it: each bucket is a range of ids, with the first row of the next range (role 1) last.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if isinstance(docs.schema["doc_id"].dataType, T.StringType):
        return in_text_order(docs, partitions)
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    # The highest ids of ranges, a set number of ids for each partition: with many ranges to a
    # task, tasks get about equal shares.
    ids = docs.select(number.alias("id")).repartitionByRange(partitions, F.col("id").desc())
    shares = [k / RANGES for k in range(1, RANGES)]
    tops = ids.groupBy(F.spark_partition_id().alias("part")).agg(
        F.max("id").alias("top"), F.percentile_approx("id", shares, 200).alias("others")
    )
    highest = np.unique(np.array([x for r in tops.collect() for x in [r["top"], *r["others"]]], np.int64))

    @F.pandas_udf("array<long>")
    def places(id_: pd.Series) -> pd.Series:
        # Bucket 0 holds the highest ids. Encoded as 2 * bucket + role.
        values = id_.to_numpy()
        bucket = len(highest) - 1 - np.searchsorted(highest, values)
        first = highest[len(highest) - 1 - bucket] == values
        before = (bucket - 1) % len(highest)
        return pd.Series(
            [[2 * b, 2 * p + 1] if f else [2 * b] for b, p, f in zip(bucket.tolist(), before.tolist(), first)]
        )

    return dealt(docs.select("doc_id", "text", number.alias("id")), places)


def in_text_order(docs: DataFrame, partitions: int) -> DataFrame:
    """`in_order` for ids that are text: a range per partition, null ids in the lowest."""
    number = F.coalesce(F.concat(F.lit("1"), F.col("doc_id")), F.lit("0"))
    ids = docs.select(number.alias("id")).repartitionByRange(partitions, F.col("id").desc())
    tops = ids.groupBy(F.spark_partition_id().alias("part")).agg(F.max("id").alias("top"))
    ascending = sorted({r["top"] for r in tops.collect()})

    @F.pandas_udf("array<long>")
    def places(id_: pd.Series) -> pd.Series:
        n, found = len(ascending), []
        for one in id_:
            # Ranges whose highest id is no lower than this one; encoded as above.
            at = bisect_left(ascending, one)
            bucket = n - at - 1
            first = ascending[at] == one
            found.append([2 * bucket, 2 * ((bucket - 1) % n) + 1] if first else [2 * bucket])
        return pd.Series(found)

    return dealt(docs.select("doc_id", "text", number.alias("id")), places)


def dealt(rows: DataFrame, places: Callable[[str], Column]) -> DataFrame:
    placed = rows.withColumn("place", F.explode(places("id")))
    placed = placed.select(
        F.shiftright("place", 1).alias("bucket"), (F.col("place") % 2).alias("role"), "id", "doc_id", "text"
    )
    return (
        placed.repartition("bucket")
        .sortWithinPartitions("bucket", "role", F.col("id").desc(), F.xxhash64("text"))
        .select("bucket", "role", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """The last third of the text's code points replaced by the first as many of another."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def edit_digests(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text, with their likenesses (see README)."""
    rows = id_and_text(docs)
    bit_map = lexicon(docs)
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type(rows)),
            T.StructField("n_chars", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
            *[T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")],
        ]
    )
    arrow = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(bit_map)
        waiting = None  # the row whose successor comes next
        bucket = None
        for batch in batches:
            for part in slices(batch):
                out = []
                columns = [part.column(c).to_pylist() for c in ("bucket", "role", "doc_id", "text")]
                for at, role, doc_id, text in zip(*columns):
                    if at != bucket:
                        bucket, waiting = at, None
                    if role and waiting is None:
                        continue
                    own = maker.fingerprint(text)
                    if waiting is not None:
                        before_id, before, mark = waiting
                        changed = edited(before, text)
                        other = maker.fingerprint(changed)
                        digest = hashlib.sha256(changed.encode()).hexdigest()
                        out.append(
                            (before_id, len(before), digest, mark, other, likeness(mark, other), likeness(mark, own))
                        )
                    waiting = None if role else (doc_id, text, own)
                if out:
                    kinds = [part.column("doc_id").type, *arrow[1:]]
                    arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return in_order(rows).mapInArrow(run, schema)

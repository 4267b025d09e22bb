"""Packing documents into windows of fixed capacity: minimum bin slack by subset-sum bit sets.

Documents become token ids once. Full windows are cut off the front of long documents; what is
left of each is a piece shorter than a window. Only the number of pieces of each length, at most
capacity - 1 numbers whatever the data, goes to the driver, which plans windows: the longest
length left and, by dynamic programming over a bit set of reachable sums, the multiset of lengths
that fills the rest closest to capacity, with counts traced back. A plan is repeated while its
lengths last, so the work depends on the capacity, not on the rows. Where no multiset fills a
window, one more piece is cut to fill it. The last window is cut at powers of two.

Which document goes where is decided in Spark: each piece has a rank among the pieces of its
length (rank in its task, plus what tasks before it have), and the plan says where ranks go.

Defined cases: a null or empty text has just the end token; repeated rows and rows with null
ids are packed like any other; an empty table gives no pieces.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from orderloom.llm.common import id_and_text, slices
from orderloom.llm.tokens import coder
from orderloom.sources.shared import keep

CAPACITY = 2048
END = 1


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length sum to at most `room` and as close to it as can be.

    Longer lengths come first; the search ends at the first length that reaches `room`.
    """
    mask = (1 << room + 1) - 1
    sums, layers = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            layers.append((length, k, sums))
            sums |= (sums << length * k) & mask
            left -= k
            k *= 2
        if sums >> room & 1:
            break
    total = sums.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    for length, k, before in reversed(layers):
        if not before >> total & 1:
            used[length] += k
            total -= length * k
    return dict(used)


class Plan:
    """Windows planned from the number of pieces of each length.

    `rows` are (tail, low, high, start, length, window, first, each, offset): of the pieces of
    length `tail` with rank in [low, high), the part of `length` from `start` on goes to window
    `window` + i // each at offset + (i % each) * length, where i = first + rank - low.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.stacks: dict[int, deque] = defaultdict(deque)
        self.left: dict[int, int] = {}
        self.rows: list[tuple[int, ...]] = []
        self.windows = 0
        for length, n in counts.items():
            if n:
                self.put(length, (length, 0, n, 0))
        while self.left:
            self.plan_windows()

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.stacks[length].append(run)
        self.left[length] = self.left.get(length, 0) + run[2] - run[1]

    def take(self, length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """Runs (tail, low, high, start) of n pieces of a length in all."""
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
        stack = self.stacks[length]
        while n:
            tail, low, high, start = stack.popleft()
            if high - low > n:
                stack.appendleft((tail, low + n, high, start))
                high = low + n
            n -= high - low
            yield tail, low, high, start

    def plan_windows(self) -> None:
        longest = max(self.left)
        used = defaultdict(int, {longest: 1})
        rest = dict(self.left)
        rest[longest] -= 1
        for length, n in fullest(rest, self.capacity - longest).items():
            used[length] += n
        slack = self.capacity - sum(length * n for length, n in used.items())
        extra = {x: n - used.get(x, 0) for x, n in self.left.items() if n > used.get(x, 0)}
        # The most plentiful length is cut, so that the plan can be repeated often.
        spare = max(extra, key=lambda x: (extra[x], -x), default=0) if slack else 0
        if slack and not spare:
            self.last_window(used)
            return
        need = {x: n + (x == spare) for x, n in used.items()} | ({} if spare in used or not spare else {spare: 1})
        repeats = min(self.left[x] // n for x, n in need.items())
        offset = 0
        for length in sorted(used, reverse=True):
            n, first = used[length], 0
            for tail, low, high, start in self.take(length, n * repeats):
                self.rows.append((tail, low, high, start, length, self.windows, first, n, offset))
                first += high - low
            offset += n * length
        if spare:
            first = 0
            for tail, low, high, start in list(self.take(spare, repeats)):
                self.rows.append((tail, low, high, start, slack, self.windows, first, 1, offset))
                first += high - low
                self.put(spare - slack, (tail, low, high, start + slack))
        self.windows += repeats

    def last_window(self, used: dict[int, int]) -> None:
        """What is left fills no window: cut it so that each sequence is a power of two long."""
        room = offset = 0
        total = sum(length * n for length, n in used.items())
        for length in sorted(used, reverse=True):
            for tail, low, high, start in list(self.take(length, used[length])):
                for rank in range(low, high):
                    at = start
                    while at < start + length:
                        if not room:
                            room, offset = 1 << total.bit_length() - 1, 0
                            total -= room
                            self.windows += 1
                        n = min(room, start + length - at)
                        self.rows.append((tail, rank, rank + 1, at, n, self.windows - 1, 0, 1, offset))
                        room, offset, at = room - n, offset + n, at + n


def tokenize(docs: DataFrame, path: str, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """row, doc_id, doc_tokens, ids (little-endian 32-bit) of every document, and its place among
    the rows of the task: `part`, `full_before` (full windows) and `tail_rank` (equal tails)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("row", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("full_before", T.LongType()),
            T.StructField("tail_rank", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row, full = part << 33, 0
        ranks: dict[int, int] = defaultdict(int)
        for batch in batches:
            for piece in slices(batch):
                ids = [x + last for x in coder(path).encode_all(piece.column("text").to_pylist())]
                out = []
                for x in ids:
                    n = len(x) // 4
                    out.append((row, part, n, full, ranks[n % capacity]))
                    row, full = row + 1, full + n // capacity
                    ranks[n % capacity] += 1
                columns = list(zip(*out)) or [[]] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *arrays, pa.array(ids, pa.binary())], names=schema.names
                )

    return id_and_text(docs).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary)."""
    spark = docs.sparkSession
    tokens = keep(tokenize(docs, path, end, capacity), "tokens")
    tail = (F.col("doc_tokens") % capacity).cast("int").alias("tail")
    whole = F.floor(F.col("doc_tokens") / capacity).cast("long")
    places = tokens.select("row", "part", "doc_tokens", "full_before", "tail_rank", tail)
    sums = places.groupBy("part", "tail").agg(F.count("*").alias("n"), F.sum(whole).alias("full"))
    sums = keep(sums, "lengths")

    before = W.rowsBetween(W.unboundedPreceding, -1)
    base = F.sum("n").over(before.partitionBy("tail").orderBy("part"))
    ranks = sums.filter("tail > 0").select("part", "tail", F.coalesce(base, F.lit(0)).alias("base"))
    # One row per task: the number of full windows in tasks before it.
    parts = sums.groupBy("part").agg(F.sum("full").alias("full"))
    counts = {r["tail"]: r["n"] for r in sums.filter("tail > 0").groupBy("tail").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, capacity)
    fulls = parts.select(
        "part",
        (F.coalesce(F.sum("full").over(before.orderBy("part")), F.lit(0)) + plan.windows).alias("window"),
    )

    names = ["tail", "low", "high", "from", "length", "window", "first", "each", "offset"]
    # Rows of the plan depend on the capacity alone, so it is small whatever the data. An Arrow table
    # needs no Python workers of its own, which a list of rows does.
    columns = list(zip(*plan.rows)) or [()] * len(names)
    table = pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
    planned = F.broadcast(spark.createDataFrame(table))
    item = F.col("first") + F.col("tail_rank") + F.col("base") - F.col("low")
    rank = F.col("tail_rank") + F.col("base")
    tails = (
        places.join(ranks, ["part", "tail"])
        .join(planned, "tail")
        .filter((rank >= F.col("low")) & (rank < F.col("high")))
        .select(
            "row",
            (F.col("doc_tokens") - F.col("tail") + F.col("from")).alias("start"),
            "length",
            (F.col("window") + F.floor(item / F.col("each"))).alias("sequence_id"),
            (F.col("offset") + item % F.col("each") * F.col("length")).alias("offset"),
        )
    )
    long = (
        places.filter(F.col("doc_tokens") >= capacity)
        .join(fulls, "part")
        .select("row", "full_before", "window", F.explode(F.sequence(F.lit(0), whole - 1)).alias("k"))
        .select(
            "row",
            (F.col("k") * capacity).cast("long").alias("start"),
            F.lit(capacity).cast("long").alias("length"),
            (F.col("window") + F.col("full_before") + F.col("k")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    pieces = tails.unionByName(long)
    return tokens.select("row", "doc_id", "doc_tokens", "ids").join(pieces, "row").select(
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        "sequence_id",
        "offset",
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"),
    )

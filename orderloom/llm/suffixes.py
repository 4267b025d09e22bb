"""Suffix-array dedup: bytes covered by a string of `width` bytes that also starts elsewhere.

Every window (string of `width` bytes) gets a key that equal windows share: the least hash of
its `GRAM`-byte strings. Neighbouring windows with one key make a run, the unit of the work. A run's
content is its bytes and those that follow up to `most` bytes from the last window's start, so that
matches of up to `most` bytes are seen whole:

1. Runs are counted by key. A key that occurs once, and whose string occurs once in its run, has
   no repeated window; its runs go no further.
2. Runs of a key with one content are one text to sort, which stands twice if the content does.
3. Texts are gathered into shards of bounded size: all of a key, and each that stands twice, by
   itself. A shard's suffixes are sorted in two stages: those smaller than their successor directly,
   the others induced from them by a scan of the buckets of first bytes. The longest match of a
   suffix is its common prefix with one of its neighbours; windows with one of at least `width`, or
   `most`, bytes are repeats. What was found for a content holds wherever it stands.
4. A key with too many contents for one shard is cut finer: its windows get the key of their
   common middle, in steps of `STEPS` windows, and go through 2 and 3 again. In the last step a key
   is one window; if it has too many continuations still, they are dealt over shards, and one of
   them goes to all, so that each has a match in its shard. No group is ever too large for a task.

Defined cases: a null or empty text, or one shorter than `width`, has nothing removed; repeated
rows are repeats of each other; rows with a null id take part; an empty table gives no rows; other
columns stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import fresh, id_and_text, id_type, slices
from orderloom.sources.shared import keep

WIDTH = 400
# A passage of more than 50 words is longer than this, by its bytes.
PASSAGE = 256
GRAM = 32
LONGEST_RUN = 512
# Windows of a text looked at together: a longer text is taken in segments, which cut runs.
SEGMENT = 1 << 20
STEPS = (32, 1)
# Contents of one key that are sorted together at most, and bytes of a shard on average.
MOST_CONTENTS = 1000
SHARD_BYTES = 1 << 20

KEY = ["k1", "k2"]
CONTENT = ["k1", "k2", "c1", "c2"]
PLACE = ["doc_id", "mark", "start", "windows"]


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """Hash of each `gram`-byte string of the data, by its place."""
    n = len(data) - gram + 1
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    h = np.zeros(n, np.uint64)
    for k in range(0, gram, 8):
        h ^= words[k : k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def least_in_windows(h: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each `size` neighbouring values."""
    done = 1
    while 2 * done <= size:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    rest = size - done
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def runs(data: bytes, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Starts, numbers of windows and keys of the runs of a text, and whether the string that
    gives the key occurs again in the text, so that windows of one run may be equal."""
    if len(data) < width:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    h = gram_hashes(data, gram)
    reach = width - gram
    keys = least_in_windows(h, reach + 1)
    # A string gives the key of some window around it if it isn't above the largest key there.
    around = ~np.concatenate([np.zeros(reach, np.uint64), keys, np.zeros(reach, np.uint64)])
    values, times = np.unique(h[h <= ~least_in_windows(around, reach + 1)], return_counts=True)
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    sizes = np.diff(np.append(starts, len(keys)))
    if sizes.max() > LONGEST_RUN:
        parts = -(-sizes // LONGEST_RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + nth * LONGEST_RUN
        sizes = np.diff(np.append(starts, len(keys)))
    again = times[np.searchsorted(values, keys[starts])] > 1
    return starts, sizes, keys[starts], again.astype(np.int64)


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def find_runs(docs: DataFrame, width: int, gram: int, most: int) -> DataFrame:
    """CONTENT, PLACE and `again` (see `runs`) of the runs of `docs` (doc_id, mark, text)."""
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("mark", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "windows", "k1", "again", "c1", "c2")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows, found, digests = [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    data = text.encode()
                    for low in range(0, max(1, len(data) - width + 1), SEGMENT):
                        segment = data[low : low + SEGMENT + width - 1]
                        starts, sizes, keys, again = runs(segment, width, gram)
                        starts = starts + low
                        # The number of windows counts too: at the end of a text it may differ.
                        digests += [
                            xxhash.xxh3_128_digest(data[a : a + n + most - 1], n)
                            for a, n in zip(starts.tolist(), sizes.tolist())
                        ]
                        found.append((starts, sizes, keys.view(np.int64), again))
                        rows.append(np.full(len(starts), row))
                at = pa.array(np.concatenate(rows))
                c1, c2 = halves(digests)
                arrays = [part.column("doc_id").take(at), part.column("mark").take(at)]
                arrays += [pa.array(np.concatenate(x)) for x in zip(*found)] + [pa.array(c1), pa.array(c2)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select("doc_id", "mark", "text").mapInArrow(run, schema)


def units(rows: DataFrame, step: int, width: int, gram: int, most: int) -> DataFrame:
    """Rows (PLACE, k2 or k1 as gram key, copies, data) cut into units of at most `step` windows.

    A window is placed by its first least-hash string: windows whose distance to it, in steps, is
    the same have a middle in common, which is the new key. Equal windows get equal keys.
    """
    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("mark", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "windows", *CONTENT, "copies")]
        + [T.StructField("data", T.BinaryType())]
    )
    reach = width - gram

    def cut(data: bytes, windows: int) -> list[tuple[int, int, bytes, bytes]]:
        h = gram_hashes(data[: windows + width - 1], gram)
        key = least_in_windows(h, reach + 1)
        order = np.arange(len(h))
        found = []
        first = np.empty(windows, np.int64)
        for value in np.unique(key):
            places = order[h == value]
            mine = np.flatnonzero(key == value)
            first[mine] = places[np.searchsorted(places, mine)]
        block = (first - np.arange(windows)) // step
        change = np.flatnonzero((np.diff(first) != 0) | (np.diff(block) != 0)) + 1
        starts = np.concatenate([[0], change])
        for a, b in zip(starts.tolist(), [*change.tolist(), windows]):
            place, k = int(first[a]), int(block[a])
            far = min(k * step + step - 1, reach)
            middle = data[place - k * step : place - far + width]
            text = data[a : b - 1 + most]
            content = xxhash.xxh3_128_digest(text + (place - a).to_bytes(4, "little"), b - a)
            found.append((a, b - a, xxhash.xxh3_128_digest(middle + k.to_bytes(4, "little")), content))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "data"):
                at, places, sizes, keys, contents, data = [], [], [], [], [], []
                texts = part.column("data").to_pylist()
                starts = part.column("start").to_pylist()
                for row, (text, start, n) in enumerate(zip(texts, starts, part.column("windows").to_pylist())):
                    for a, count, key, content in cut(text, n):
                        at.append(row)
                        places.append(start + a)
                        sizes.append(count)
                        keys.append(key)
                        contents.append(content)
                        data.append(text[a : a + count - 1 + most])
                rows_at = pa.array(at, pa.int64())
                arrays = [part.column("doc_id").take(rows_at), part.column("mark").take(rows_at)]
                arrays += [pa.array(places, pa.int64()), pa.array(sizes, pa.int64())]
                arrays += [pa.array(x) for x in (*halves(keys), *halves(contents))]
                arrays += [part.column("copies").take(rows_at), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.select("doc_id", "mark", "start", "windows", "copies", "data").mapInArrow(run, schema)


def settle(rows: DataFrame, *carried: str) -> DataFrame:
    """One row for each content that must be sorted, with one of its places.

    Rows have CONTENT, PLACE, copies (how often the row's content is known to occur), again (1 if
    it may hold equal windows itself) and the carried columns. The result also has `contents`, the
    number of contents of the key (null if no content that occurs once needs to be compared with
    them), and `leads`, whether the content is the least of its key.
    """
    counted = rows.groupBy(*CONTENT).agg(
        F.sum("copies").alias("copies"),
        F.max("again").alias("again"),
        *[F.first(c).alias(c) for c in (*PLACE, *carried)],
    )
    counted = keep(counted, "contents")
    groups = counted.groupBy(*KEY).agg(
        F.count("*").alias("contents"),
        F.sum((F.col("copies") == 1).cast("long")).alias("open"),
        F.max("again").alias("inside"),
        F.min(F.struct("c1", "c2")).alias("least"),
    )
    groups = groups.filter("(contents > 1 or inside > 0) and open > 0").select(*KEY, "contents", "least")
    # A table of its own, so that the join may split a key with many contents.
    joined = counted.drop("again").join(keep(groups, "groups"), KEY, "left")
    leads = F.coalesce(F.struct("c1", "c2") == F.col("least"), F.lit(False))
    return joined.filter("contents is not null or copies > 1").withColumn("leads", leads).drop("least")


def with_data(rows: DataFrame, docs: DataFrame, most: int) -> DataFrame:
    """The bytes of each row (PLACE, ...) taken from its document, as column data."""
    others = [c for c in rows.columns if c not in ("doc_id", "mark")]
    wanted = rows.groupBy("doc_id", "mark").agg(F.collect_list(F.struct(*others)).alias("parts"))
    wanted = wanted.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "parts")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    found = docs.join(wanted, same).select(
        "doc_id", "mark", F.encode("text", "UTF-8").alias("bytes"), F.explode("parts").alias("p")
    )
    piece = F.expr(f"substring(bytes, cast(p.start + 1 as int), cast(p.windows + {most - 1} as int))")
    found = found.select("doc_id", "mark", *[F.col(f"p.{c}") for c in others], piece.alias("data"))
    # A document that is in the table twice gives each part twice.
    return found.dropDuplicates(CONTENT)


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes in the order of their first `depth` bytes.

    Every wanted suffix that is larger than its successor must have a wanted successor.
    """
    n = len(text)
    rises = np.flatnonzero(text[1:] != text[:-1])
    # The type of a suffix is that of the end of its run of equal bytes.
    nxt = np.concatenate([[0], np.cumsum(text[1:] != text[:-1])]) if n else np.zeros(0, np.int64)
    smaller = np.zeros(n, bool)
    inner = nxt < len(rises)
    end = rises[nxt[inner]]
    smaller[inner] = text[end] < text[end + 1]
    data = text.tobytes()
    direct = np.flatnonzero(smaller & wanted).tolist()
    direct.sort(key=lambda i: data[i : i + depth])
    direct = np.array(direct, np.int64)
    cuts = np.searchsorted(text[direct], np.arange(257))
    large: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and wanted[n - 1]:
        large[text[n - 1]].append(np.array([n - 1]))
    order = []
    for byte in range(256):
        induced = np.concatenate(large[byte]) if large[byte] else np.zeros(0, np.int64)
        front, parts = induced, [induced]
        while len(front):
            front = front[front > 0] - 1
            front = front[(text[front] == byte) & wanted[front]]
            parts.append(front)
        bucket = np.concatenate([*parts, direct[cuts[byte] : cuts[byte + 1]]])
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > byte) & wanted[before]]
        if len(before):
            firsts = text[before]
            sort = np.argsort(firsts, kind="stable")
            values, at = np.unique(firsts[sort], return_index=True)
            for value, part in zip(values, np.split(before[sort], at[1:])):
                large[value].append(part)
    return np.concatenate(order)


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes are the same from a on and from b on, up to `most`."""
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    found = np.full(len(a), most, np.int64)
    left = np.arange(len(a))
    data = padded.tobytes()
    for k in range(0, most, 8):
        if k == 64:
            # What has come so far is mostly the same to the end.
            pairs = zip(a[left].tolist(), b[left].tolist())
            same = np.array([data[x : x + most] == data[y : y + most] for x, y in pairs], bool)
            left = left[~same]
        differ = words[a[left] + k] ^ words[b[left] + k]
        end = np.flatnonzero(differ)
        if len(end):
            low = differ[end] & -differ[end]
            found[left[end]] = k + np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8
            left = left[differ == 0]
        if not len(left):
            break
    return np.minimum(found, most)


def longest_matches(texts: list[bytes], windows: list[int], most: int) -> list[np.ndarray]:
    """For each text and each of its first windows, the longest string, up to `most` bytes, that
    starts there and also starts elsewhere in the texts, at one of their first windows."""
    gap = b"\xff"  # is in no UTF-8 text
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    text = np.frombuffer(gap.join(texts) + gap, np.uint8)
    wanted = np.zeros(len(text) + 1, np.int8)
    valid = np.zeros(len(text) + 1, np.int8)
    # Up to the first suffix that is certain to be smaller than its successor.
    falls = np.append(np.flatnonzero(text[:-1] < text[1:]), len(text) - 1)
    ends = starts[:-1] + np.array(windows, np.int64)
    last = np.minimum(falls[np.searchsorted(falls, ends - 1)], starts[1:] - 1)
    for flags, end in ((valid, ends), (wanted, last + 1)):
        np.add.at(flags, starts[:-1], 1)
        np.add.at(flags, end, -1)
    valid = np.cumsum(valid[:-1]).astype(bool)
    order = two_stage_order(text, np.cumsum(wanted[:-1]).astype(bool), most)
    order = order[valid[order]]
    # A match ends with its text.
    rest = starts[np.searchsorted(starts, order, "right")] - 1 - order
    shared = common_prefixes(text, order[:-1], order[1:], most)
    shared = np.minimum(shared, np.minimum(rest[:-1], rest[1:]))
    found = np.zeros(len(text), np.int64)
    found[order[1:]] = shared
    found[order[:-1]] = np.maximum(found[order[:-1]], shared)
    return [found[s : s + n] for s, n in zip(starts, windows)]


def repeated_windows(texts: list[bytes], windows: list[int], width: int) -> list[np.ndarray]:
    """For each text, which of its first windows also start elsewhere in the texts."""
    return [found >= width for found in longest_matches(texts, windows, width)]


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def sort_shards(rows: DataFrame, width: int, most: int, last: bool) -> DataFrame:
    """What sorting finds in the contents of `rows` (see `settle`, with data).

    PLACE and CONTENT of the content, twice (whether it occurs twice), wide (whether the match has
    `most` bytes), low and high in the content. Keys with more than MOST_CONTENTS contents are
    left to a finer cut, but in the last step.
    """
    total = rows.agg(F.sum(F.length("data")).alias("n")).first()["n"] or 0
    shards = F.lit(max(1, -(-2 * total // SHARD_BYTES)))
    carried = ["doc_id", "mark", "start", "windows", *CONTENT, "data"]
    schema = T.StructType(
        [rows.schema[c] for c in carried[:-1]]
        + [T.StructField(c, T.BooleanType()) for c in ("twice", "wide")]
        + [T.StructField(c, T.LongType()) for c in ("low", "high")]
    )
    widths = [width] if most == width else [width, most]

    def one(table: pa.Table) -> pa.Table:
        if last:
            # A content that goes to all parts of its key may meet itself here.
            keys = zip(table.column("twice").to_pylist(), *[table.column(c).to_pylist() for c in CONTENT])
            first = {key: row for row, key in reversed(list(enumerate(keys)))}
            table = table.take(pa.array(sorted(first.values()), pa.int64()))
        texts, windows = table.column("data").to_pylist(), table.column("windows").to_pylist()
        twice, told = table.column("twice").to_pylist(), table.column("told").to_pylist()
        again = [k for k, t in enumerate(twice) if t]
        found = longest_matches(
            texts + [texts[k] for k in again], windows + [windows[k] for k in again], most
        )
        at, wide, lows, highs = [], [], [], []
        for row, longest in enumerate(found[: len(texts)]):
            for least in widths if told[row] else []:
                low, high = stretches(longest >= least)
                at += [row] * len(low)
                wide += [least == most] * len(low)
                lows += low.tolist()
                highs += (high + least - 1).tolist()
        columns = [table.column(c).take(pa.array(at, pa.int64())) for c in [*carried[:-1], "twice"]]
        columns += [pa.array(wide, pa.bool_()), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())]
        return pa.table(columns, names=schema.names)

    # Contents that occur twice: their copies alone decide, wherever they are sorted.
    pairs = rows.filter("copies > 1").withColumns(
        {"shard": F.pmod(F.xxhash64(*CONTENT), shards), "twice": F.lit(True), "told": F.lit(True)}
    )
    if last:
        parts = F.ceil(F.col("contents") / max(1, MOST_CONTENTS))
        every = F.sequence(F.lit(0).cast("long"), parts - 1)
        own = F.array(F.pmod(F.xxhash64(*CONTENT), parts))
        keyed = rows.filter("contents is not null")
        keyed = keyed.withColumn("part", F.explode(F.when(F.col("leads"), every).otherwise(own)))
    else:
        keyed = rows.filter(F.col("contents") <= MOST_CONTENTS).withColumn("part", F.lit(0).cast("long"))
    keyed = keyed.withColumns(
        {
            "shard": F.pmod(F.xxhash64(*KEY, "part"), shards),
            "twice": F.lit(False),
            "told": F.col("copies") == 1,
        }
    )
    columns = ["shard", "twice", "told", *carried]
    dealt = pairs.select(*columns).unionByName(keyed.select(*columns))
    return dealt.groupBy("shard").applyInArrow(one, schema)


def placed(found: DataFrame, rows: DataFrame) -> DataFrame:
    """doc_id, mark, low, high, wide: what was found, wherever the contents stand.

    Rows whose content was known to occur twice before have been told of then.
    """
    low, high = [(F.col("start") + F.col(c)).alias(c) for c in ("low", "high")]
    columns = ["doc_id", "mark", low, high, "wide"]
    twice = found.filter("twice").select(*CONTENT, "low", "high", "wide")
    copies = rows.filter("copies = 1").select(*PLACE, *CONTENT).join(twice, CONTENT)
    return found.filter("not twice").select(*columns).unionByName(copies.select(*columns))


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and a mark of the text, so that rows are told apart where ids repeat."""
    return id_and_text(docs).withColumn("mark", F.xxhash64("text"))


def repeated_spans(
    texts: DataFrame, width: int = WIDTH, gram: int = GRAM, most: int | None = None
) -> DataFrame:
    """doc_id, mark, low, high, wide: byte spans covered by repeated windows; spans may overlap.

    Spans of windows of `width` bytes, and, as `wide`, of windows of `most` (the same if not given).
    """
    most = most or width
    found = keep(find_runs(texts, width, gram, most), "runs").withColumnRenamed("k1", "key")
    often = found.groupBy("key").agg(F.count("*").alias("n"), F.max("again").alias("again"))
    # A table of its own, so that the join may split a key with many runs.
    often = keep(often.filter("n > 1 or again > 0").select("key"), "keys")
    rows = found.join(often, "key", "left_semi").withColumnRenamed("key", "k1")
    rows = keep(rows.withColumns({"k2": F.lit(0).cast("long"), "copies": F.lit(1).cast("long")}), "often")
    left = keep(with_data(settle(rows), texts, most), "open")
    spans = None
    for step in (*STEPS, None):
        sorted_ = keep(sort_shards(left, width, most, step is None), "sorted")
        these = placed(sorted_, rows)
        spans = these if spans is None else spans.unionByName(these)
        if step is not None:
            crowded = left.filter(F.col("contents") > MOST_CONTENTS)
            # Windows of one unit differ in where their string stands, so they are never equal.
            rows = keep(units(crowded, step, width, gram, most).withColumn("again", F.lit(0)), "units")
            left = keep(settle(rows, "data"), "open")
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as maximal runs, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[e for span in spans for e in span], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def covered(docs: DataFrame, name: str, width: int, gram: int, most: int | None = None) -> DataFrame:
    """`docs` and a column `name`: the byte spans (low, high, wide) repeated in its text, null if none."""
    found = repeated_spans(marked(docs), width, gram, most)
    of, key = fresh([*docs.columns, name], "of", "key")
    listed = found.groupBy(F.col("doc_id").alias(of), F.col("mark").alias(key)).agg(
        F.collect_set(F.struct("low", "high", "wide")).alias(name)
    )
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col(key)
    )
    return docs.join(listed, same, "left").select(*docs.columns, name)


def removal_digests(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, passage: int | None = None
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    With `passage`, a shorter width, also n_repeated: bytes covered by repeated strings of that width.
    """
    counts = ["n_bytes", "n_removed", "n_spans", *(["n_repeated"] if passage else [])]
    schema = T.StructType(
        [T.StructField("doc_id", id_type(docs))]
        + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField("kept_sha256", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                data = (text.as_py() or "").encode()
                spans = spans.as_py() or []
                runs_of = merged([(s["low"], s["high"]) for s in spans if s["wide"]])
                short = merged([(s["low"], s["high"]) for s in spans])
                kept = kept_bytes(data, runs_of)
                row = (len(data), len(data) - len(kept), len(runs_of), sum(b - a for a, b in short))
                out.append((*row[: len(counts)], hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [[]] * (len(counts) + 1)
            kinds = [pa.int64()] * len(counts) + [pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=schema.names)

    given = covered(id_and_text(docs), "spans", passage or width, gram, width)
    return given.select("doc_id", "text", "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The rows of `docs` with repeated passages cut out of the text; n_chars follows the text.

    A cut through a character drops what is left of it. Documents of which nothing is left go.
    """
    (name,) = fresh(docs.columns, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch)):
            texts, keep_row = [], []
            for text, spans in zip(part.column("text").to_pylist(), part.column(name).to_pylist()):
                if spans:
                    left = kept_bytes(text.encode(), merged([(s["low"], s["high"]) for s in spans]))
                    text = left.decode("utf-8", "ignore")
                keep_row.append(not spans or bool(text.strip()))
                texts.append(text)
            out = part.drop_columns([name])
            place = out.schema.get_field_index("text")
            out = out.set_column(place, "text", pa.array(texts, out.schema.field("text").type))
            yield out.filter(pa.array(keep_row, pa.bool_()))

    cut = covered(docs, name, width, gram).mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.length("text").cast(kind))
    return cut.select(*docs.columns)

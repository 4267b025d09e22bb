"""Language identification by partial matching: the language whose model codes a text shortest.

Each language has a tree of byte contexts of up to ORDER bytes, with the counts of what followed
them in training. A byte is coded in the longest context known, by its share of that context's
count; if it never followed, an escape is coded (method C: as probable as the context has different
successors) and the next shorter context is tried, down to all bytes alike. Counts are frozen after
training, so the code length of a byte depends on it and the ORDER bytes before alone, and can be
looked up: one table per number of bytes holds, for every string of any language's tree, its code
length in each language. Strings are told apart exactly. Lengths are whole numbers of 1/65536
bit, so sums are exact whatever is added first. Naming the language costs bits too, by its share.

Texts are lower-cased, and start in the context of line ends. The whole text is coded.

Defined cases: a null text, or one without a letter, is `und` with score 0, as is every text if no
language was learnt; a null or text doc_id and repeated rows are allowed; rows without lang, or
with a text of more than LONGEST bytes, are not learnt from; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import id_type, is_held_out, slices

ORDER = 4
UNIT = 1 << 16
# Bounds on the training sample: documents of a language, bytes of a document, bytes in all.
PER_LANGUAGE, LONGEST, MOST_BYTES = 600, 20_000, 64_000_000
# Contexts of three bytes or more keep what followed at least so often.
TIMES = 2
BLOCK = 1 << 18
PAD = "\n" * ORDER
FREE = np.uint64((1 << 64) - 1)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Places:
    """Where each of some keys stands: an exact hash table."""

    def __init__(self, keys: np.ndarray):
        bits = max(8, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, FREE)
        self.rows = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        at = self.home(keys)
        while len(left):
            free = np.flatnonzero(self.keys[at] == FREE)
            slot, first = np.unique(at[free], return_index=True)
            taken = free[first]
            self.keys[slot], self.rows[slot] = keys[left[taken]], left[taken]
            rest = np.ones(len(left), bool)
            rest[taken] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * FACTOR) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it has none."""
        at = self.home(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.rows[at], -1)
        left = np.flatnonzero((held != keys) & (held != FREE))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            held = self.keys[at[left]]
            same = held == keys[left]
            found[left[same]] = self.rows[at[left[same]]]
            left = left[~same & (held != FREE)]
        return found


@dataclass
class Model:
    """Code lengths in units of 1/UNIT bit, with a column per language.

    strings[j], lengths[j]: strings of j bytes, and the length of their last byte after the others.
    contexts[j], escapes[j]: contexts of j bytes, and the length of an escape from them.
    """

    languages: list[str]
    names: np.ndarray
    strings: list[Places | None]
    lengths: list[np.ndarray]
    contexts: list[Places | None]
    escapes: list[np.ndarray]


def mask(n: int) -> np.uint64:
    return np.uint64((1 << (8 * n)) - 1)


def windows(data: bytes) -> np.ndarray:
    """The eight bytes from each place on as a number, the first one lowest."""
    return np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))


def counted(texts: list[str], order: int, times: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each j up to order + 1: the strings of j bytes that end in the texts, and their counts."""
    data = [("\n" * order + t).encode() for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    joined = b"".join(data)
    inside = np.ones(len(joined), bool)
    for k in range(order):
        inside[np.cumsum(sizes) - sizes + k] = False
    last = np.flatnonzero(inside)
    eight = windows(joined)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for j in range(1, order + 2):
        keys, n = np.unique(eight[last - (j - 1)] & mask(j), return_counts=True)
        often = n >= (times if j > 3 else 1)
        found.append((keys[often], n[often]))
    return found


def bits(share: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(share) * UNIT).astype(np.int32)


def fit(texts: dict[str, list[str]], shares: dict[str, float], order: int = ORDER, times: int = TIMES) -> Model:
    """The model of these texts by language; `shares` are the languages' own probabilities."""
    languages = sorted(texts)
    own = [counted(texts[name], order, times) for name in languages]
    strings, lengths, contexts, escapes = [None], [np.zeros((0, len(own)), np.int32)], [], []
    for j in range(1, order + 2):
        keys = np.unique(np.concatenate([o[j][0] for o in own])) if own else np.zeros(0, np.uint64)
        before = np.unique(keys & mask(j - 1))
        place, of = Places(keys), Places(before)
        length = np.zeros((len(keys), len(own)), np.int32)
        escape = np.zeros((len(before), len(own)), np.int32)
        # After an escape: the length in the next shorter context.
        shorter = lengths[j - 1][strings[j - 1].find(keys >> np.uint64(8))] if j > 1 else 8 * UNIT
        context = of.find(keys & mask(j - 1))
        for k, o in enumerate(own):
            mine, n = o[j]
            at, total, different = of.find(mine & mask(j - 1)), np.zeros(len(before)), np.zeros(len(before))
            np.add.at(total, at, n)
            np.add.at(different, at, 1)
            known = total > 0
            escape[known, k] = bits(different[known] / (total + different)[known])
            length[:, k] = (shorter[:, k] if j > 1 else shorter) + escape[context, k]
            length[place.find(mine), k] = bits(n / (total + different)[at])
        strings.append(place)
        lengths.append(length)
        contexts.append(of)
        escapes.append(escape)
    total = sum(shares.values()) or 1.0
    names = bits(np.array([shares[name] / total for name in languages], float)).astype(np.int64)
    return Model(languages, names, strings, lengths, contexts, escapes)


def byte_lengths(model: Model, eight: np.ndarray) -> np.ndarray:
    """Code length in each language of the byte ORDER places after each of the given ones."""
    order = len(model.contexts) - 1
    out = np.empty((len(eight), len(model.languages)), np.int32)
    left = np.arange(len(eight))
    for j in range(order + 1, 0, -1):
        keys = (eight >> np.uint64(8 * (order + 1 - j))) & mask(j)
        row = model.strings[j].find(keys)
        seen = row >= 0
        if j == order + 1:
            out[:] = 0
        out[left[seen]] += model.lengths[j][row[seen]]
        left, eight, keys = left[~seen], eight[~seen], keys[~seen]
        if not len(left):
            break
        row = model.contexts[j - 1].find(keys & mask(j - 1))
        seen = row >= 0
        out[left[seen]] += model.escapes[j - 1][row[seen]]
    out[left] += 8 * UNIT
    return out


def code_lengths(model: Model, data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Code length in each language of the texts data[offsets[k]:offsets[k + 1]], each with its PAD."""
    order = len(model.contexts) - 1
    sums = np.zeros((len(offsets) - 1, len(model.languages)), np.int64)
    eight = windows(data)
    for low in range(0, len(data), BLOCK):
        high = min(len(data), low + BLOCK)
        found = byte_lengths(model, eight[low:high])
        first = np.searchsorted(offsets, low, "right") - 1
        end = np.searchsorted(offsets, high, "left")
        # The last places of a text have their byte in the next text.
        stops = offsets[first + 1 : end + 1]
        for k in range(1, order + 1):
            inside = stops[(stops - k >= low) & (stops - k < high)] - k
            found[inside - low] = 0
        starts = np.maximum(offsets[first:end], low) - low
        sums[first:end] += np.add.reduceat(found, starts, axis=0, dtype=np.int64)
    return sums + model.names


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def training_sample(docs: DataFrame) -> tuple[dict[str, list[str]], dict[str, float]]:
    """Bounded samples of texts by language outside the held-out rows, and each language's rows.

    The PER_LANGUAGE documents with the least hashes, fewer if there are so many languages that
    MOST_BYTES could be exceeded; texts of more than LONGEST bytes are not in the sample.
    """
    known = docs.select(
        F.col("lang").cast("string").alias("lang"),
        lowered(F.col("text")).alias("text"),
        F.xxhash64("doc_id", "text").alias("mark"),
        is_held_out(F.col("doc_id")).alias("held_out"),
    ).filter("lang is not null and not held_out")
    rows = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    shares = {r["lang"]: float(r["n"]) for r in rows}
    most = max(1, min(PER_LANGUAGE, MOST_BYTES // (LONGEST * max(1, len(shares)))))
    usable = known.filter(F.octet_length("text").between(1, LONGEST))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    chosen = usable.select("lang", "mark").withColumn("nth", nth).filter(F.col("nth") <= most)
    # At most PER_LANGUAGE rows per language.
    chosen = F.broadcast(chosen.select("lang", "mark").distinct())
    texts: dict[str, list[str]] = {name: [] for name in shares}
    sample = usable.join(chosen, ["lang", "mark"]).groupBy("lang", "mark").agg(F.first("text").alias("text"))
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["mark"])):
        texts[r["lang"]].append(r["text"])
    return texts, shares


def train(docs: DataFrame) -> Model:
    return fit(*training_sample(docs))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the language's probability, given all code lengths), bits_per_byte."""
    schema = T.StructType(
        [T.StructField("doc_id", id_type(docs)), T.StructField("lang_pred", T.StringType()),
         T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    )
    languages = np.array([*model.languages, "und"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text")
                width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
                offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset :][: len(texts) + 1].astype(np.int64)
                data = texts.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes()
                offsets -= offsets[0]
                told = part.column("told").to_numpy(zero_copy_only=False).astype(bool)
                if model.languages:
                    lengths = code_lengths(model, data, offsets)
                    best = lengths.argmin(axis=1)
                    least = lengths.min(axis=1)
                    odds = np.exp2(-np.minimum((lengths - least[:, None]) / UNIT, 1000.0))
                    score = 1 / odds.sum(axis=1)
                else:
                    told &= False
                    best, least, score = np.zeros((3, len(told)))
                name = languages[np.where(told, best, -1).astype(int)]
                rate = least / UNIT / np.maximum(1, np.diff(offsets) - ORDER)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(name, pa.string()), pa.array(np.where(told, score, 0.0)),
                     pa.array(np.where(told, rate, 0.0))],
                    names=schema.names,
                )

    text = F.col("text")
    told = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    given = docs.select("doc_id", told.alias("told"), F.concat(F.lit(PAD), lowered(text)).alias("text"))
    return given.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learnt from the rows that are not held out."""
    return predict(docs, train(docs)).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )

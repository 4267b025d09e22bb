"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed character n-grams of its lower-cased form. Each is
scaled by the log ratio of its smoothed document frequencies in the two classes, and logistic
regression with weight decay is fitted on the scaled features.

Defined cases: a null or empty text has the n-grams of two spaces only; without labels of both
classes every score is the share of label 1; whole texts count, in windows, so a very long text
needs no more memory than a window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import id_and_text, is_held_out, map_texts, slices, training_texts

BITS = 18
SIZES = (3, 4, 5, 6)
WINDOW = 1 << 20
THRESHOLD = 0.3
# Bound on the training sample: documents of each class.
PER_CLASS = {0: 4000, 1: 2000}


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def hashed(codes: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of a run of code points."""
    found = []
    for n in SIZES:
        if len(codes) < n:
            continue
        h = np.zeros(len(codes) - n + 1, np.uint64)
        for k in range(n):
            h = h * np.uint64(1000003) + codes[k : len(codes) - n + 1 + k]
        h = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((h >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def features(text: str, seen: np.ndarray) -> np.ndarray:
    """Distinct buckets of a whole text; `seen` is a zeroed scratch array and is left zeroed."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    found = []
    for start in range(0, len(codes), WINDOW):
        h = hashed(codes[start : start + WINDOW + max(SIZES) - 1])
        order = np.arange(1, len(h) + 1, dtype=np.int32)
        h = h[seen[h] >= 0]
        order = order[: len(h)]
        seen[h] = order
        new = h[seen[h] == order]
        seen[new] = -1
        found.append(new)
    all_of = np.concatenate(found)
    seen[all_of] = 0
    return all_of


def fit(
    sample: list[tuple[int, str]],
    share: float,
    top: int = 2000,
    min_docs: int = 3,
    decay: float = 1e-4,
    steps: int = 200,
) -> Model:
    """Fit on (label, text) pairs; `share` of label 1 undoes that the classes are sampled apart.

    The `top` features with the largest ratios, weighed by frequency, take part.
    """
    size = 1 << BITS
    y = np.array([label for label, _ in sample], float)
    if not 0 < y.sum() < len(y):
        odds = np.clip(share, 0.01, 0.99)
        return Model(np.zeros(size, np.float32), float(np.log(odds / (1 - odds))))
    seen = np.zeros(size, np.int32)
    counts = np.zeros((2, size))
    for label, text in sample:
        counts[label][features(text, seen)] += 1
    ratio = np.log((counts[1] + 1) / (y.sum() + 2)) - np.log((counts[0] + 1) / ((1 - y).sum() + 2))
    frequent = np.flatnonzero(counts.sum(0) >= min(min_docs, len(y)))
    strength = np.abs(ratio[frequent]) * np.sqrt(counts.sum(0)[frequent])
    chosen = frequent[np.argsort(-strength, kind="stable")[:top]]

    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    # The texts are read again rather than all their n-grams held.
    rows = []
    for _, text in sample:
        row = place[features(text, seen)]
        rows.append(row[row >= 0])
    doc = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
    column = np.concatenate(rows)
    value = ratio[chosen][column]
    weigh = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))

    w, bias = np.zeros(len(chosen)), float(np.log(share / (1 - share)))
    mean, square = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        z = np.bincount(doc, value * w[column], len(rows)) + bias
        error = weigh * (sigmoid(z) - y) / len(rows)
        slope = np.bincount(column, value * error[doc], len(chosen)) + decay * w
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    weights = np.zeros(size, np.float32)
    weights[chosen] = w * ratio[chosen]
    return Model(weights, float(bias))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: more likely toxic) of every row."""
    weights, bias = model.weights, model.bias

    def scores(texts: list[str]) -> list:
        seen = np.zeros(len(weights), np.int32)
        sums = [weights[features(t, seen)].sum(dtype=np.float64) for t in texts]
        return [sigmoid(np.array(sums, float) + bias)]

    return map_texts(id_and_text(docs), scores, [("score", pa.float64(), T.DoubleType())])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(*training_texts(docs, labels, "toxic", PER_CLASS))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    return score(docs, train(docs, labels)).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that score below the threshold, all columns as they are."""
    weights, bias = model.weights, model.bias
    line = float(np.log(THRESHOLD / (1 - THRESHOLD)))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                seen = np.zeros(len(weights), np.int32)
                texts = part.column("text")
                sums = [weights[features(t.as_py() or "", seen)].sum(dtype=np.float64) for t in texts]
                yield part.filter(pa.array(np.array(sums, float) + bias < line))

    return docs.mapInArrow(run, docs.schema)

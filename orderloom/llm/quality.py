"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by counts of its signs and words and a
learned layer; a gated attention gives each passage a weight, learned from the documents' labels
alone; the document's score is read off the weighted mean of its passages' representations.

Defined cases: a null or empty text is one empty passage; without labels of both classes every
score is the share of label 1; whole texts count, passage by passage.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import id_and_text, is_held_out, map_texts, training_texts

PASSAGE = 64  # words
HIDDEN = 24
GATE = 16
THRESHOLD = 0.7
# Bound on the training sample: documents of each class.
PER_CLASS = {0: 2500, 1: 3500}
BUCKETS = 32

# Classes of bytes: lower, upper, digit, space, line end, other ASCII by bucket, rest.
KINDS = np.full(256, 5, np.int64)
KINDS[ord("a") : ord("z") + 1] = 0
KINDS[ord("A") : ord("Z") + 1] = 1
KINDS[ord("0") : ord("9") + 1] = 2
KINDS[[9, 11, 12, 13, 32]] = 3
KINDS[10] = 4
for _place, _sign in enumerate(b".,;:!?'\"()[]{}<>|#*&%$@=+-_/\\~^`"):
    KINDS[_sign] = 6 + _place
N_KINDS = int(KINDS.max()) + 1
N_FEATURES = N_KINDS + BUCKETS + 6


def passages(text: str) -> np.ndarray:
    """One row of numbers per passage of a text: shares of kinds of bytes, of word forms, and how
    often words and neighbouring words repeat."""
    words = text.split(" ")
    rows = []
    for start in range(0, len(words), PASSAGE):
        part = words[start : start + PASSAGE]
        data = np.frombuffer(" ".join(part).encode(), np.uint8)
        kinds = np.bincount(KINDS[data], minlength=N_KINDS) / max(1, len(data))
        sizes = np.array([len(w) for w in part])
        forms = np.bincount(np.minimum(sizes, BUCKETS - 1), minlength=BUCKETS) / len(part)
        again = sum(a == b for a, b in zip(part, part[1:])) / len(part)
        lowered = len(set(part)) / len(part)
        pairs = len(set(zip(part, part[1:]))) / max(1, len(part) - 1)
        rest = [again, lowered, pairs, sizes.mean() / 10, sizes.std() / 10, len(part) / PASSAGE]
        rows.append(np.concatenate([kinds, forms, rest]))
    return np.array(rows, np.float32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags; `starts` are their first passages, `bag` each passage's bag."""
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        v, u = np.tanh(h @ w["value"]), sigmoid(h @ w["gate"])
        raw = (v * u) @ w["attend"]
        raw = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        share = raw / np.add.reduceat(raw, starts)[bag]
        z = np.add.reduceat(h * share[:, None], starts)
        p = sigmoid(z @ w["read"] + w["read_bias"])
        return {"h": h, "v": v, "u": u, "share": share, "z": z, "p": p}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        sizes = np.array([len(b) for b in bags])
        starts = np.cumsum(sizes) - sizes
        x = (np.concatenate(bags) - self.center) / self.scale
        return self.forward(x, starts, np.repeat(np.arange(len(bags)), sizes))["p"].astype(float)


def fit(sample: list[tuple[int, str]], share: float, epochs: int = 30, batch: int = 64) -> Model:
    """Fit on (label, text) pairs; `share` of label 1 undoes that the classes are sampled apart."""
    random = np.random.default_rng(7)
    y = np.array([label for label, _ in sample], float)
    shapes = {
        "encode": (N_FEATURES, HIDDEN),
        "encode_bias": (HIDDEN,),
        "value": (HIDDEN, GATE),
        "gate": (HIDDEN, GATE),
        "attend": (GATE,),
        "read": (HIDDEN,),
        "read_bias": (1,),
    }
    w = {k: random.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32) for k, s in shapes.items()}
    odds = np.clip(share, 0.01, 0.99)
    w["encode_bias"][:] = 0
    w["read_bias"][:] = np.log(odds / (1 - odds))
    ones = np.ones(N_FEATURES, np.float32)
    if not 0 < y.sum() < len(y):
        return Model(0 * ones, ones, {k: v if k == "read_bias" else 0 * v for k, v in w.items()})
    bags = [passages(text) for _, text in sample]
    every = np.concatenate(bags)
    model = Model(every.mean(0), every.std(0) + 0.01, w)
    bags = [(b - model.center) / model.scale for b in bags]
    weigh = np.where(y == 1, odds / y.mean(), (1 - odds) / (1 - y.mean()))
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = np.array([len(bags[k]) for k in chosen])
            starts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(chosen)), sizes)
            x = np.concatenate([bags[k] for k in chosen])
            slopes = backward(model, x, starts, bag, y[chosen], weigh[chosen])
            step += 1
            rate = 0.01 * (1 - 0.9 * epoch / epochs)
            for k, slope in slopes.items():
                slope = slope + 1e-4 * w[k]
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                square[k] = 0.99 * square[k] + 0.01 * slope**2
                w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)
    return model


def backward(
    model: Model, x: np.ndarray, starts: np.ndarray, bag: np.ndarray, y: np.ndarray, weigh: np.ndarray
) -> dict[str, np.ndarray]:
    """Slopes of the weighted log loss."""
    w, f = model.weights, model.forward(x, starts, bag)
    h, v, u, share = f["h"], f["v"], f["u"], f["share"]
    error = (weigh * (f["p"] - y) / len(y)).astype(np.float32)
    dz = error[:, None] * w["read"][None, :]
    dshare = (h * dz[bag]).sum(1)
    draw = share * (dshare - np.add.reduceat(share * dshare, starts)[bag])
    dv, du = draw[:, None] * u * w["attend"], draw[:, None] * v * w["attend"]
    dv, du = dv * (1 - v**2), du * u * (1 - u)
    dh = share[:, None] * dz[bag] + dv @ w["value"].T + du @ w["gate"].T
    dh = dh * (1 - h**2)
    return {
        "encode": x.T @ dh,
        "encode_bias": dh.sum(0),
        "value": h.T @ dv,
        "gate": h.T @ du,
        "attend": (v * u).T @ draw,
        "read": f["z"].T @ error,
        "read_bias": error.sum(keepdims=True),
    }


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 more likely) of every row."""

    def scores(texts: list[str]) -> list:
        return [model.scores([passages(t) for t in texts])]

    return map_texts(id_and_text(docs), scores, [("score", pa.float64(), T.DoubleType())])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(*training_texts(docs, labels, "quality", PER_CLASS))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    return score(docs, train(docs, labels)).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

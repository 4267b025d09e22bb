"""Ranked search against scores of every document, by plain counting."""

import math
import random
import re
from collections import Counter

import pytest
from corpus import AWKWARD, docs
from pyspark.sql import types as T

from orderloom.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = T.StructType(
    [T.StructField(*f) for f in (("item_id", T.LongType()), ("text", T.StringType()), ("rank", T.StringType()),
                                 ("ids", T.StringType()), ("copies", T.StringType()))]
)


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def expected(rows, items, top):
    counted = [(r[0], Counter(terms(r[1]))) for r in rows]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, total = len(counted), sum(k for _, _, k in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, length in counted:
            m = 50 + (50 * length * n) // total
            score = 0
            for t in set(terms(text)):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def made(seed, n):
    chance = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["The", "ä", "☃1", "x_y"]
    rows = []
    for i in range(n):
        length = chance.choice([3, 20, 60, 400])
        rows.append((i, " ".join(words[int(len(words) * chance.random() ** 3)] for _ in range(length))))
    return rows


def found(spark, rows, items, top=50, partitions=3):
    frame = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in items], ITEMS)
    result = ranked.rank_documents(docs(spark, rows).repartition(partitions), frame, top)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, result.collect()), key=str)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(ranked, "DOCS", 17)
    monkeypatch.setattr(ranked, "RESCORED", 4)
    monkeypatch.setattr(ranked, "FIRST", 3)


def test_against_brute_force(spark, small_blocks):
    rows = made(1, 500) + AWKWARD
    rows += [(1000 + k, "the same rare words everywhere w399") for k in range(200)]
    items = [(k, text) for k, (_, text) in enumerate(made(2, 12))]
    items += [(100, "rare words"), (101, None), (102, "?!"), (103, "nothing known"), (None, "w1 w2"), (104, "w1 w1 W1")]
    assert found(spark, rows, items, 10) == expected(rows, items, 10)


def test_repeated_items_and_documents(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "b c d"), (3, "z")]
    items = [(5, "a d"), (5, "a d"), (6, "a d")]
    assert found(spark, rows, items) == expected(rows, items, 50)


def test_text_ids_and_empty(spark):
    frame = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one")], "doc_id string, text string")
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    rows = [tuple(r)[:3] for r in ranked.rank_documents(frame, items).orderBy("rank").collect()]
    assert rows == [(1, 1, "a"), (1, 2, "b")]
    assert ranked.rank_documents(frame.limit(0), items).collect() == []
    assert ranked.rank_documents(frame, items.limit(0)).collect() == []


def test_bounds_hold_and_exclude(spark):
    """No document's bound is below its score, and most documents are never scored."""
    rows = made(3, 3000)
    row = ranked.indexed(fill(rows))
    counted = [Counter(terms(t)) for _, t in rows]
    n, total = len(rows), sum(row["lengths"])
    df = Counter(t for c in counted for t in c)
    queries = ranked.Queries([[t.encode() for t in terms(made(4, 1)[0][1])]], {k.encode(): v for k, v in df.items()}, n)
    maps = ranked.slices_of(queries, row)
    for level, least in enumerate(ranked.LEVELS[: len(maps)]):
        bits = ranked.np.unpackbits(maps[level], axis=1, count=n)
        for k, term in enumerate(queries.terms):
            has = [c[term.decode()] >= least for c in counted]
            assert all(b for b, h in zip(bits[k], has) if h)
    best = [ranked.Best(1, 10)]
    assert ranked.search_block(queries, row, n, total, best) < n / 4
    assert len(best[0].rows) == 10


def fill(rows):
    block = ranked.Block()
    for i, text in rows:
        block.add(i, Counter(t.encode() for t in terms(text)))
    return block


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "ITEM_BYTES", 200)
    rows, items = made(5, 60), [(k, text[:80]) for k, (_, text) in enumerate(made(6, 8))]
    assert found(spark, rows, items, 5) == expected(rows, items, 5)

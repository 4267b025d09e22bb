"""Language identification against a plain form of the model, and on held-out documents."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import AWKWARD, docs
from pyspark.sql import functions as F

from orderloom.llm import language


def made(seed, syllables, n, words=40):
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices(syllables, k=chance.randint(1, 3)))
    return [" ".join(word() for _ in range(chance.randint(1, words))) + "." for _ in range(n)]


TONGUES = {"aa": ["the", "ing", "on", "er"], "bb": ["ü", "sch", "ver", "on"], "cc": ["ón", "ci", "que", "er"]}


class Plain:
    """Counts of what follows each context, one language."""

    def __init__(self, texts, order, times):
        every = Counter()
        for text in texts:
            data = language.PAD[:order].encode() + text.encode()
            for i in range(order, len(data)):
                for j in range(order + 1):
                    every[data[i - j : i], data[i]] += 1
        self.after = defaultdict(dict)
        for (context, byte), n in every.items():
            if n >= (times if len(context) >= 3 else 1):
                self.after[context][byte] = n

    def length(self, context, byte):
        cost = 0.0
        while True:
            if context in self.after:
                seen = self.after[context]
                total = sum(seen.values()) + len(seen)
                if byte in seen:
                    return cost - math.log2(seen[byte] / total)
                cost -= math.log2(len(seen) / total)
            if not context:
                return cost + 8
            context = context[1:]

    def text(self, text, order):
        data = language.PAD[:order].encode() + text.encode()
        return sum(self.length(data[i - order : i], data[i]) for i in range(order, len(data)))


@pytest.mark.parametrize("block", [7, 50, 1 << 18])
def test_lengths_against_plain_form(monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    texts = {name: made(k, syllables, 60) for k, (name, syllables) in enumerate(TONGUES.items())}
    shares = {"aa": 5.0, "bb": 3.0, "cc": 2.0}
    model = language.fit(texts, shares)
    plain = {name: Plain(own, language.ORDER, language.TIMES) for name, own in texts.items()}
    asked = ["", "a", "\n", "ü", "theing on", "ÿ☃\x00zz", "ver" * 30]
    asked += [t for k, s in enumerate(TONGUES.values()) for t in made(9 + k, [*s, "x"], 5)]
    data = [(language.PAD + t).encode() for t in asked]
    offsets = np.cumsum([0] + [len(d) for d in data])
    found = language.code_lengths(model, b"".join(data), offsets) / language.UNIT
    for row, text in zip(found, asked):
        for got, name in zip(row, model.languages):
            want = plain[name].text(text, language.ORDER) - math.log2(shares[name] / 10)
            assert got == pytest.approx(want, abs=1e-3 + 1e-4 * len(text)), (text, name)


def corpus_rows():
    rows = []
    for k, (name, syllables) in enumerate(TONGUES.items()):
        rows += [(1000 * k + i, t, name) for i, t in enumerate(made(20 + k, syllables, 150))]
    return rows


def with_lang(spark, rows):
    langs = {r[0]: r[2] for r in rows if r[0] is not None}
    frame = docs(spark, [r[:2] for r in rows])
    lookup = F.create_map(*[F.lit(x) for pair in langs.items() for x in pair])
    return frame.withColumn("lang", lookup[F.col("doc_id")])


def test_held_out_and_awkward(spark):
    rows = corpus_rows() + [(i if i is None else 10_000 + i, t, None) for i, t in AWKWARD] + [
        (20_000, "123 !?", "aa"), (20_001, "", None), (20_002, "verüschon " * 40_000, None),
    ]
    found = language.identify(with_lang(spark, rows).repartition(5))
    assert found.dtypes == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double"),
    ]
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert sum(map(len, got.values())) == len(rows)
    right = [got[i][0][0] == lang for i, t, lang in corpus_rows() if len(t) > 30]
    assert np.mean(right) > 0.97
    assert got[10_000] == got[10_001] == got[20_000] == got[20_001] == [("und", 0.0)]
    assert got[10_002] == [("und", 0.0)] and got[20_002][0][0] == "bb"
    assert len(got[10_003]) == 2 and got[10_003][0] == got[10_003][1]
    assert all(0 <= s <= 1 for x in got.values() for _, s in x)


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = corpus_rows()
    frame = with_lang(spark, rows)
    spoilt = frame.withColumn("lang", F.when(language.is_held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    one, two = (sorted(map(tuple, language.identify(f).collect())) for f in (frame, spoilt))
    assert one == two


def test_nothing_learnt(spark):
    frame = with_lang(spark, [(1, "some text", None), (2, None, None)])
    assert {r["lang_pred"] for r in language.identify(frame).collect()} == {"und"}
    assert language.identify(frame.limit(0)).collect() == []


def test_given_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(frame).join(frame.select("doc_id", "lang"), "doc_id").filter("held_out")
    share = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.97

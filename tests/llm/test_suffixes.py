import hashlib
import random
from collections import Counter

import pytest
from corpus import AWKWARD, docs

from orderloom.llm import suffixes


def expected(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, width, gram):
    found = suffixes.removal_digests(docs(spark, rows), width, gram).collect()
    got = sorted((str(r[0]), *r[1:]) for r in found)
    want = expected([r[1] for r in rows], width)
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, want))


def corpus(seed, n=60):
    """Texts with copies, near copies, shared passages, repeats inside and periodic stretches."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    passage = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(n):
        t = " ".join(word() for _ in range(rng.randrange(0, 60)))
        kind = rng.randrange(6)
        if kind == 0 and texts:
            t = rng.choice(texts)
        elif kind == 1 and texts:
            old = rng.choice(texts).split(" ")
            old[rng.randrange(len(old))] = word()
            t = " ".join(old)
        elif kind in (2, 3):
            t = t + passage[rng.randrange(40) : len(passage) - rng.randrange(40)] + t[::-1]
        elif kind == 4:
            t += "=" * rng.randrange(200) + t[: rng.randrange(1, 50)] * 2
        texts.append(t)
    return [(k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    check(spark, corpus(seed), 40, 16)


@pytest.mark.parametrize("segment", [1, 7, 100])
def test_long_texts_in_segments(spark, monkeypatch, segment):
    """Segments change nothing. (Tasks import the module anew, so the runs are compared here.)"""
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    for _, text in corpus(3, 20) + list(enumerate(PERIODIC)):
        data = text.encode()
        whole = suffixes.runs(data, 40, 16)
        keys = lambda r, low=0: {low + s + k: key for s, n, key in zip(*r[:3]) for k in range(n)}
        parts = {}
        for low in range(0, max(1, len(data) - 39), segment):
            parts |= keys(suffixes.runs(data[low : low + segment + 39], 40, 16), low)
        assert parts == keys(whole)


@pytest.mark.parametrize("most", [0, 4])
def test_crowded_keys_are_cut_finer(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_CONTENTS", most)
    check(spark, corpus(7), 40, 16)


PERIODIC = ["Nd, " * 100, "x" * 41, "y" * 40, "0123456789abcdef" * 3 + "#", "the same again " * 9 + "end", "pq" * 400 + "r" * 90]


@pytest.mark.parametrize("most", [1000, 0])
def test_repeats_within_one_run(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_CONTENTS", most)
    check(spark, list(enumerate(PERIODIC)), 40, 16)
    for k, text in enumerate(PERIODIC):
        check(spark, [(k, text)], 40, 16)


def test_awkward_rows(spark):
    check(spark, AWKWARD, 40, 16)


def test_empty_table(spark):
    assert suffixes.removal_digests(docs(spark, [])).count() == 0


def test_sorting_matches_plain_sort():
    rng = random.Random(1)
    for _ in range(30):
        width = rng.choice([3, 8, 20])
        texts = [
            bytes(rng.randrange(97, 100) for _ in range(rng.randrange(width, width * 8)))
            for _ in range(rng.randrange(1, 12))
        ]
        windows = [rng.randrange(1, len(t) - width + 2) for t in texts]
        seen = Counter(t[i : i + width] for t, n in zip(texts, windows) for i in range(n))
        want = [[seen[t[i : i + width]] > 1 for i in range(n)] for t, n in zip(texts, windows)]
        got = suffixes.repeated_windows(texts, windows, width)
        assert [list(map(bool, g)) for g in got] == want


def test_removal_keeps_columns_and_clean_rows(spark):
    passage = " ".join(f"passage{k}" for k in range(60))
    rows = [(1, "a" + passage), (2, passage + "b"), (3, "clean"), (4, None)]
    out = suffixes.remove_repeats(docs(spark, rows))
    assert out.columns == docs(spark, []).columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a", 2: "b", 3: "clean", 4: None}


def covered(texts, width):
    return [row[1] for row in expected(texts, width)]


@pytest.mark.parametrize("most", [1000, 3, 0])
def test_shorter_passages_against_brute_force(spark, monkeypatch, most):
    """Both widths from one sorting, also where keys are cut finer and continuations dealt over shards."""
    monkeypatch.setattr(suffixes, "MOST_CONTENTS", most)
    rng = random.Random(5)
    line = "the very common line of thirty and more bytes "
    rows = corpus(11, 40) + [(100 + k, line + "".join(rng.choices("abcd ", k=rng.randrange(40)))) for k in range(30)]
    rows += [(200 + k, t) for k, t in enumerate(PERIODIC)]
    got = {r["doc_id"]: r for r in suffixes.removal_digests(docs(spark, rows), 40, 16, 24).collect()}
    texts = [t for _, t in rows]
    for (i, _), want, short in zip(rows, expected(texts, 40), covered(texts, 24)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want
        assert r.n_repeated == short


def test_longest_matches_against_plain_comparison():
    rng = random.Random(2)
    for _ in range(20):
        most = rng.choice([5, 9, 30, 400])
        texts = [bytes(rng.choices(b"ab", k=rng.randrange(5, 60))) * rng.choice([1, 1, 8]) for _ in range(rng.randrange(1, 6))]
        windows = [rng.randrange(1, len(t) + 1) for t in texts]
        starts = [(k, i) for k, n in enumerate(windows) for i in range(n)]
        common = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        found = suffixes.longest_matches(texts, windows, most)
        for k, i in starts:
            others = [common(texts[k][i:], texts[m][j:]) for m, j in starts if (m, j) != (k, i)]
            assert found[k][i] == min(most, max(others, default=0))


def test_passages_of_over_fifty_words(spark):
    """Planted passages of 51 to 60 words go, clean texts stay as they are."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(51 + k % 10) for k in range(20)]
    rows = [(i, text(80)) for i in range(100)]
    for k, passage in enumerate(passages):
        rows += [(1000 + 10 * k + j, f"{text(30)} {passage} {text(30)}") for j in range(2 + k % 3)]
    out = {r.doc_id: r.text for r in suffixes.remove_repeats(docs(spark, rows), suffixes.PASSAGE).collect()}
    assert all(out[i] == t for i, t in rows if i < 1000)
    assert not any(p in t for p in passages for t in out.values())
    assert sum(len(t) for i, t in rows if i >= 1000) - sum(len(out[i]) for i, _ in rows if i >= 1000) > 0

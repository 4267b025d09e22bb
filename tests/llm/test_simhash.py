import random

import numpy as np
import xxhash
from corpus import AWKWARD, docs

from orderloom.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, radius=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def check(spark, rows):
    got = sorted(
        ((r.doc_id is None, r.doc_id or 0, r.fp & (2**64 - 1), r.component_id)
         for r in simhash.near_duplicates(docs(spark, rows)).collect()),
        key=str,
    )
    fps = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(fps)
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    want = sorted(
        ((i is None, i or 0, fp, least[r]) for (i, _), fp, r in zip(rows, fps, root)), key=str
    )
    assert got == want


def corpus(n=150):
    rng = random.Random(3)
    texts = []
    for _ in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 120))]
        if texts and rng.random() < 0.5:
            words = rng.choice(texts).split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = "Changed"
        texts.append(" ".join(words))
    return [(k + 5, t) for k, t in enumerate(texts)]


def test_against_brute_force(spark):
    check(spark, corpus())


def test_awkward_rows(spark):
    check(spark, AWKWARD)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.one_of_each(docs(spark, [])).count() == 0


def test_forest_connects_what_all_pairs_connect(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(0)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 12)).astype(np.uint64)
    fps = np.unique(np.concatenate([seeds, (seeds[:, None] ^ flips).ravel(), (seeds[:, None] ^ flips ^ flips[:, ::-1]).ravel()]))
    want = plain_components([int(x) for x in fps])
    half = len(fps) // 2
    for parts in ([(fps, None)], [(fps[:half], None), (fps[half:], None), (fps[:half], fps[half:])]):
        place = {int(x): k for k, x in enumerate(fps)}
        root = list(range(len(fps)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in (e for p in parts for e in zip(*simhash.forest(*p, 4))):
            assert (int(a) in place) and (int(b) in place)
            root[find(place[int(a)])] = find(place[int(b)])
        got = [find(i) for i in range(len(fps))]
        same = {}
        assert all(same.setdefault(w, g) == g for w, g in zip(want, got))
        assert len(set(got)) == len(set(want))


def test_one_of_each(spark):
    rows = corpus() + AWKWARD
    kept = simhash.one_of_each(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    fps = [plain_fingerprint(t) for _, t in rows]
    groups = {}
    for (i, _), r in zip(rows, plain_components(fps)):
        groups.setdefault(r, []).append(i)
    want = [min([x for x in ids if x is not None], default=None) for ids in groups.values()]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, want))

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus import AWKWARD, docs
from tokenizers import Tokenizer

from orderloom.llm import packing, tokens
from orderloom.llm.tokens import WordCoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(spark, library, rows, capacity=2048):
    """Every id in one piece, sequences gapless, and padding only where a power of two allows."""
    pieces = packing.pack(docs(spark, rows), PATH, capacity).collect()
    got = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces:
        assert 0 < p.length <= capacity and len(p.ids) == 4 * p.length
        got[p.doc_id].append((p.start, bytes(p.ids), p.doc_tokens))
        sequences[p.sequence_id].append((p.offset, p.length))
    for doc_id in got:
        want = Counter()
        for i, text in rows:
            if i == doc_id:
                want[encoded(library, text).tobytes()] += 1
        (n,) = {len(w) // 4 for w in want} if len(want) == 1 else (None,)
        if n is not None:
            copies = sum(want.values())
            joined = Counter()
            for start, ids, total in got[doc_id]:
                assert total == n
                joined.update((start + k, ids[4 * k : 4 * k + 4]) for k in range(len(ids) // 4))
            ids = next(iter(want))
            assert joined == {(k, ids[4 * k : 4 * k + 4]): copies for k in range(n)}
    total = sum(len(encoded(library, t)) for _, t in rows)
    assert sum(p.length for p in pieces) == total
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0


def test_pieces(spark, library):
    rng = random.Random(0)
    rows = [(100 + k, " ".join(rng.choice(["the", "cat's", "naïve", "x1"]) for _ in range(rng.randrange(900)))) for k in range(80)]
    check(spark, library, rows)
    check(spark, library, rows, 64)


def test_awkward_rows(spark, library):
    check(spark, library, AWKWARD)


def test_equal_lengths(spark, library):
    check(spark, library, [(k, "one two three four") for k in range(500)], 16)


def test_empty_table(spark):
    assert packing.pack(docs(spark, []), PATH).count() == 0


def test_ids_as_the_library_gives_them(library):
    coder, rng = WordCoder(PATH), random.Random(2)
    signs = [*map(chr, range(0x180)), "İ", "Σ", "́", "日", "😀", "—", "Ж", "<|endoftext|>"]
    for _ in range(2000):
        text = "".join(rng.choice(signs) if rng.random() < 0.4 else rng.choice("ab c'st1., ") for _ in range(40))
        assert coder.encode(text) == encoded(library, text)[:-1].tobytes(), text


def test_ids_of_many_texts_at_once(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_STRINGS", 20)
    coder, rng = WordCoder(PATH), random.Random(5)
    words = ["the", "cat's", "naïve", "x1.", "wait...", "\u00a0", "\x0b\x0c", "日本", "(end)", "ÉTÉ,", "<|endoftext|>", "Σ"]
    for _ in range(40):
        texts = ["", *(" ".join(rng.choices(words, k=rng.randrange(30))) for _ in range(9)), "a. b, c.\n"]
        assert coder.encode_all(texts) == [encoded(library, t)[:-1].tobytes() for t in texts]
    assert coder.encode_all([]) == []


def test_strings_in_use_stay_known(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_STRINGS", 100)
    coder, learned = WordCoder(PATH), Counter()
    learn = coder.learn
    monkeypatch.setattr(coder, "learn", lambda string: learned.update([string]) or learn(string))
    for k in range(400):
        coder.encode_all(["often seen", f"once{k}"])
    assert learned["often"] == learned["seen"] == 1
    assert len(coder.known) + len(coder.older) <= 100


@pytest.mark.parametrize("seed", range(6))
def test_fullest_against_all_subsets(seed):
    rng = random.Random(seed)
    for _ in range(30):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(0, 80)
        sums = {0}
        for length, n in counts.items():
            sums |= {s + length * k for s in sums for k in range(n + 1)}
        used = packing.fullest(counts, room)
        assert all(n <= counts[x] for x, n in used.items())
        assert sum(x * n for x, n in used.items()) == max(s for s in sums if s <= room)


def test_plan_does_not_grow_with_the_rows():
    rng = random.Random(3)
    counts = Counter(rng.randrange(1, 256) for _ in range(20_000))
    small = packing.Plan(counts, 256)
    large = packing.Plan({x: 1000 * n for x, n in counts.items()}, 256)
    assert len(large.rows) < 2 * len(small.rows) + 1000


def test_crc_of_digests(spark, library):
    from orderloom.llm.registry import piece_digests

    rows = [(1, "some text " * 3000), (2, None)]
    for p in piece_digests(docs(spark, rows)).collect():
        ids = encoded(library, dict(rows)[p.doc_id])[p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(ids.tobytes())

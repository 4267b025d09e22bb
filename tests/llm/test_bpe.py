import hashlib
import random

import public_tokenizers
import pytest
from corpus import AWKWARD, docs
from tokenizers import Tokenizer

from orderloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def texts(n):
    rng = random.Random(0)
    parts = [" the", "in", "g", "er", "a", "aa", "é", "ß", "日", "😀", " ", "\n", "\t", "1", "23", "'s", "'ll", ".", "==", "<|endoftext|>", "\x1c", "\xa0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_and_texts_as_the_library_gives_them(codec, library):
    for text in texts(1500):
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_any_ids_decode_as_the_library_does(codec, library):
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(30))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_any_merges_against_plain_merging():
    """Random vocabularies, merged rank by rank and left to right."""
    for seed in range(40):
        rng = random.Random(seed)
        vocab, merges, tokens = {"a": 0, "b": 1, "c": 2}, [], ["a", "b", "c"]
        while len(merges) < 12:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in vocab:
                vocab[u + v] = len(vocab)
                merges.append((u, v))
                tokens.append(u + v)
        automaton = bpe.Automaton(vocab, merges)
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
            parts = list(word)
            for u, v in merges:
                k = 0
                while k < len(parts) - 1:
                    if (parts[k], parts[k + 1]) == (u, v):
                        parts[k : k + 2] = [u + v]
                    k += 1
            assert automaton.encode(word.encode()) == [vocab[p] for p in parts]


def test_frames(spark, library):
    rows = AWKWARD + [(100 + k, t) for k, t in enumerate(texts(50))]
    got = bpe.digests(docs(spark, rows), PATH).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(ids), digest(",".join(map(str, ids))), digest(text)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = bpe.decode(bpe.encode(docs(spark, rows), PATH), PATH).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert bpe.digests(docs(spark, []), PATH).count() == 0

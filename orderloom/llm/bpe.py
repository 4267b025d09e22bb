"""Byte-level BPE by automaton: merges compiled one by one, words encoded by table look-ups.

The automaton reads tokens and accepts just the token sequences that the merges produce. At
first it has one state that reads every byte and returns to itself. Merge (u, v) -> w adds to
every state that reads u an arc on w to where v leads, and sends all arcs on u to a copy of
their target that no longer reads v. (A merge whose parts never meet changes nothing.) So each
token has one target state at a time, each merge makes one copy, and a state is stored as its
place in the chain of copies for one token.

A word's encoding is the one path through the automaton whose labels spell the word. It is
found longest token first; a position that leads nowhere is not tried again. Decoding emits the
arc labels.

Defined cases: a null or empty text has no tokens; special tokens are found first, as whole
strings, and the stretches between them are split on their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderloom.llm.common import id_and_text, map_texts

# Fixed value: the pattern that splits text into words before the merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Pieces of text that a worker remembers the encoding of, in each of two halves; the older one is dropped.
CACHE_PIECES = 500_000
# A stop after a word and before white space: a word of the pattern ends before it.
STOPS = re.compile(r"[.,](?<=[^\W_].)(?=\s)")


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary, as sign -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        """`vocab` and `merges` in signs; each merge must make a token no earlier merge made."""
        signs = byte_signs()
        self.label = {i: bytes(signs[c] for c in token) for token, i in vocab.items()}
        made_by = {vocab[u + v]: (vocab[u], vocab[v]) for u, v in merges}
        if len(made_by) != len(merges):
            raise ValueError("two merges make the same token")
        base = [i for i in self.label if i not in made_by]
        if any(len(self.label[i]) != 1 for i in base):
            raise ValueError("a token of several bytes has no merge")
        # State 0 reads everything. Tokens: target state, time, first part of the merge.
        self.target = dict.fromkeys(base, 0)
        self.time = [0] * (max(self.label, default=-1) + 1)
        self.first = [-1] * len(self.time)
        # Copies of one token's target follow each other, so states come in chains: the chain
        # and place of a state, a chain's states and their times, the state its first one
        # copies, and the place from which on a chain no longer reads a token.
        self.chain, self.place = [-1], [0]
        self.states: dict[int, list[int]] = {}
        self.births: dict[int, list[int]] = {}
        self.root: dict[int, int] = {}
        self.removed: dict[int, int] = {}
        for now, (u, v) in enumerate(merges, 1):
            self.gadget(now, vocab[u], vocab[v], vocab[u + v])
        self.arcs: dict[int, bool] = {}
        self.compile_prefixes()

    def gadget(self, now: int, u: int, v: int, w: int) -> None:
        """Nothing changes if no path has u before v: earlier merges take one of them away."""
        if u not in self.target or v not in self.target or not self.reads(self.target[u], v):
            return
        middle = self.target[u]
        self.target[w], self.time[w], self.first[w] = self.target[v], now, u
        if u not in self.states:
            self.states[u], self.births[u], self.root[u] = [], [], middle
        self.target[u] = len(self.chain)
        self.chain.append(u)
        self.place.append(len(self.states[u]))
        self.removed[u << 20 | v] = len(self.states[u])
        self.states[u].append(self.target[u])
        self.births[u].append(now)

    def reads(self, state: int, token: int) -> bool:
        """Whether the state has an arc on the token.

        A state made after the token has the arcs of the state it copies, but for one; in an
        older state, the token's arc was added wherever there was one on its first part.
        """
        while state:
            u, k = self.chain[state], self.place[state]
            if self.removed.get(u << 20 | token, k + 1) <= k:
                return False
            births, made = self.births[u], self.time[token]
            if births[k] <= made:
                token = self.first[token]
            elif births[0] > made:
                state = self.root[u]
            else:
                state = self.states[u][bisect_right(births, made, 0, k) - 1]
        return True

    def compile_prefixes(self) -> None:
        """A trie of the labels: a node is a table byte -> (node, token that ends there or -1).

        `shorter` gives the longest token that is a proper prefix of a token.
        """
        self.trie: dict = {}
        self.shorter = {}
        # Shorter labels first, so that a label's prefixes are in the trie before it.
        for i in sorted(self.target, key=lambda i: len(self.label[i])):
            node, last = self.trie, -1
            *path, end = self.label[i]
            for byte in path:
                below, token = node.get(byte, (None, -1))
                if below is None:
                    below = {}
                    node[byte] = below, token
                last = token if token >= 0 else last
                node = below
            self.shorter[i] = last
            node[end] = node.get(end, ({}, -1))[0], i
        self.sizes = {i: len(label) for i, label in self.label.items()}

    def encode(self, word: bytes) -> list[int]:
        """The token ids of one word."""
        trie, sizes, arcs, target = self.trie, self.sizes, self.arcs, self.target
        end = len(word)
        path: list[int] = []
        dead: set[int] = set()
        at, state = 0, 0
        while at < end:
            node, found = trie, -1
            for byte in word[at:] if at else word:
                below = node.get(byte)
                if below is None:
                    break
                node, token = below
                if token >= 0:
                    found = token
            while True:
                if found >= 0:
                    past = at + sizes[found]
                    if past not in dead:
                        key = state << 20 | found
                        ok = arcs.get(key)
                        if ok is None:
                            if len(arcs) > 500_000:
                                arcs.clear()
                            ok = arcs[key] = self.reads(state, found)
                        if ok:
                            break
                    found = self.shorter[found]
                else:
                    # No arc leads on from here: go back, and on with a shorter token.
                    dead.add(at)
                    found = path.pop()
                    at -= sizes[found]
                    state = target[path[-1]] if path else 0
                    found = self.shorter[found]
            path.append(found)
            at, state = past, target[found]
        return path


class Codec:
    """Encodes and decodes texts with a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab = content["model"]["vocab"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in content["model"]["merges"]]
        self.automaton = Automaton({t: i for t, i in vocab.items() if t not in special}, merges)
        self.special = special
        self.find = regex.compile(WORDS)
        ordered = sorted(special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if special else None
        self.known: dict[str, tuple[str, bytes]] = {}
        self.older: dict[str, tuple[str, bytes]] = {}
        self.signs = {i: s.encode() for s, i in special.items()}
        self.numbers = {i: str(i) for i in vocab.values()} | {i: str(i) for i in self.signs}

    def words(self, text: str) -> list[str]:
        """The words of a text; special tokens are words of their own."""
        if self.split is None or not any(s in text for s in self.special):
            return self.find.findall(text)
        found = []
        for k, part in enumerate(self.split.split(text)):
            found += [part] if k % 2 else self.find.findall(part)
        return found

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return self.automaton.encode(word.encode())

    def encode(self, text: str) -> list[int]:
        return [i for word in self.words(text) for i in self.ids(word)]

    def labels(self, ids: list[int]) -> bytes:
        label, signs = self.automaton.label, self.signs
        return b"".join([label[i] if i in label else signs[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.labels(ids).decode("utf-8", "replace")

    def piece(self, piece: str) -> tuple[str, bytes]:
        """Comma-joined ids and the labels of a string whose encoding stands on its own."""
        if piece[1:].isalpha() and piece[0] == " ":
            ids = self.automaton.encode(piece.encode())
        else:
            ids = [i for word in self.words(piece) for i in self.ids(word)]
        return ",".join([self.numbers[i] for i in ids]), self.labels(ids)

    def pieces(self, text: str) -> list[str] | None:
        """The text cut before single spaces, and before a stop that ends a word: no word of the
        pattern spans these places. Cuts before a stop are marked by a leading zero sign, all
        others but the first stand for a space. None if the text has wider or special spacing.
        """
        if "  " in text or "\0" in text or any(s in text for s in self.special):
            return None
        return STOPS.sub(" \0\\g<0>", text).split(" ")

    def parts(self, text: str) -> list[tuple[str, bytes]]:
        """The ids and labels of the pieces of a text, in order."""
        known, pieces = self.known, self.pieces(text)
        if pieces is None:
            pieces = ["", *["\0" + word for word in self.words(text)]]
        first, rest = pieces[0], pieces[1:]
        parts = list(map(known.get, rest))
        if None in parts:
            if len(known) > CACHE_PIECES:
                # What was asked for since then comes back from the older half.
                self.older, self.known = known, {}
                known = self.known
            older = self.older
            for piece in set(rest).difference(known):
                found = older.get(piece)
                known[piece] = found or self.piece(piece[1:] if piece[:1] == "\0" else " " + piece)
            parts = list(map(known.__getitem__, rest))
        return [self.piece(first), *parts] if first else parts

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, sha256 of the comma-joined ids, sha256 of the decoded text."""
        ids, labels = zip(*self.parts(text)) if text else ((), ())
        joined = ",".join(ids)
        decoded = b"".join(labels).decode("utf-8", "replace")
        return (
            joined.count(",") + bool(joined),
            hashlib.sha256(joined.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker and vocabulary."""
    if path not in CODECS:
        CODECS[path] = Codec(path)
    return CODECS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every row."""

    def run(texts: list[str]) -> list:
        return [[codec(path).encode(t) for t in texts]]

    return map_texts(id_and_text(docs), run, [("ids", pa.list_(pa.int32()), T.ArrayType(T.IntegerType()))])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids decode to an empty text."""

    def run(batches):
        for batch in batches:
            texts = [codec(path).decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    schema = T.StructType([encoded.schema["doc_id"], T.StructField("text", T.StringType())])
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded and decoded."""

    def run(texts: list[str]) -> list:
        return list(zip(*[codec(path).digest(t) for t in texts])) or [[], [], []]

    fields = [
        ("n_tokens", pa.int64(), T.LongType()),
        ("ids_sha256", pa.string(), T.StringType()),
        ("decoded_sha256", pa.string(), T.StringType()),
    ]
    return map_texts(id_and_text(docs), run, fields)

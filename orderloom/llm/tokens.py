"""Token ids of whole texts with a vocabulary of the tokenizers library, fast for repeated words."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from orderloom.llm.bpe import byte_signs

# Strings whose ids a worker remembers, so long as no text has more by itself.
CACHE_STRINGS = 400_000
# Signs outside those known to be split, lower-cased and composed alike by all libraries.
ODD = regex.compile("[^\x00-\x1b\x20-\x7f\xa0-\u012f\u0131-\u017f\u0410-\u044f\u2013-\u2026\u4e00-\u9fff]")
# The end of a word before a comma or full stop: a word of the pattern always ends there.
STOPS = re.compile(r"[.,](?<=[^\W_].)(?=\s)")


class WordCoder:
    """Ids as the library's `encode(text, add_special_tokens=False)` gives them.

    For a vocabulary of words with word ends whose texts are put in NFC, lower-cased and split
    into words without white space, the ids of what stands between white space don't depend on
    its neighbours, so each such string is given to the library once. Texts with special tokens,
    or with signs whose lower case or class may differ between libraries, are given to it whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        # The model reads each byte as a printable sign.
        self.signs = {byte: sign for sign, byte in byte_signs().items()}
        # Fixed value: the pattern of the words.
        self.find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, text: str) -> bool:
        return not any(s in text for s in self.special) and (
            text.isascii() and text.isprintable() or not ODD.search(text)
        )

    def learn(self, string: str) -> bytes:
        """Ids of a new string; its words are looked up, or given to the library's model."""
        parts = []
        for word in [string] if string.isalpha() else self.find.findall(string):
            found = self.known.get(word)
            if found is None:
                if not (word.isascii() and word.isprintable()):
                    word = word.encode().decode("latin-1").translate(self.signs)
                found = array("I", [token.id for token in self.library.model.tokenize(word)]).tobytes()
            parts.append(found)
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def remembered(self, strings: list[str]) -> list[bytes]:
        """Ids of distinct strings; half of the memory, what was not asked for of late, is forgotten at once."""
        parts = list(map(self.known.get, strings))
        new = parts.count(None)
        if len(self.known) + new > CACHE_STRINGS // 2:
            self.known, self.older = {}, self.known
            self.known.update((s, p) for s, p in zip(strings, parts) if p is not None)
        if new:
            known, older, learn = self.known, self.older, self.learn
            for i, part in enumerate(parts):
                if part is None:
                    string = strings[i]
                    parts[i] = known[string] = older.get(string) or learn(string)
        return parts

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a string is looked up once."""
        plain = [self.plain(text) for text in texts]
        spaced = [STOPS.sub(r" \g<0>", text.lower()) if ok else "" for text, ok in zip(texts, plain)]
        strings = pc.utf8_split_whitespace(pa.array(spaced, pa.string()))
        del spaced
        numbered = strings.flatten().dictionary_encode()
        bounds, number = strings.offsets.to_numpy(), numbered.indices.to_numpy()
        parts = self.remembered(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        del strings, numbered
        # Numbers of 32 bits do: a text of Arrow has less than 2 GB, and no more ids than bytes.
        sizes = np.fromiter(map(len, parts), np.int32, len(parts)) // 4
        first = np.cumsum(sizes, dtype=np.int32) - sizes
        ids = np.frombuffer(b"".join(parts), "<u4")
        sizes, first = sizes[number], first[number]
        ends = np.zeros(len(number) + 1, np.int32)
        np.cumsum(sizes, out=ends[1:])
        first -= ends[:-1]
        places = np.repeat(first, sizes)
        places += np.arange(len(places), dtype=np.int32)
        ids, bounds = ids[places], ends[bounds]
        return [
            ids[low:high].tobytes() if ok else self.whole(text)
            for text, ok, low, high in zip(texts, plain, bounds, bounds[1:])
        ]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """One coder per worker and vocabulary."""
    if path not in CODERS:
        CODERS[path] = WordCoder(path)
    return CODERS[path]

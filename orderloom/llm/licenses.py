"""License scans: short notices found despite a few typing errors.

A notice that occurs with at most e edits contains one of any e + 1 pieces of it unchanged. So
each notice is split into e + 1 seeds, the seeds are sought exactly, and the regex library checks
every span around each that the notice may have with its bounded-error matching and tells the edits.

Texts are compared as words joined by single spaces. Defined cases: a null or empty text, or one
without words, has no labels and score 0; repeated rows are scanned each; spans of one notice
don't overlap.
"""

from __future__ import annotations

from bisect import bisect, bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderloom.llm.common import id_and_text, map_texts, plain_words

# Phrases that give a label wherever their words stand consecutively.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices sought with errors: one edit for every ten signs, three at most. The words that tell
# alike notices apart must stand in the span as they are, as words of the text.
NOTICES = [
    ("mit", "under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ""),
    ("apache-2", "licensed under the apache license version 2", "2"),
    ("cc-by-nc", "licensed under cc by nc", "nc"),
    ("cc-by-sa", "licensed under cc by sa", "sa"),
    ("cc0", "licensed under cc0 1 0 universal", "cc0"),
    ("gpl-3", "gnu general public license version 3", "3"),
    ("gpl-2", "gnu general public license version 2", "2"),
    ("lgpl", "gnu lesser general public license", ""),
    ("agpl-3", "gnu affero general public license version 3", "3"),
    ("mpl-2", "mozilla public license version 2", "2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", ""),
    ("proprietary", "all rights reserved", ""),
]


@dataclass
class Notice:
    label: str
    text: bytes
    edits: int
    telling: bytes
    seeds: list[tuple[int, bytes]] = field(default_factory=list)
    pattern: regex.Pattern | None = None
    quick: regex.Pattern | None = None

    def __post_init__(self):
        parts = self.edits + 1
        cuts = [len(self.text) * k // parts for k in range(parts + 1)]
        self.seeds = [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]
        near = b"(?:" + regex.escape(self.text) + b"){e<=" + str(self.edits).encode() + b"}"
        self.quick, self.pattern = regex.compile(near), regex.compile(b"(?b)" + near)

    def origins(self, words: bytes) -> set[int]:
        """Where the notice would start, were all before a seed that stands there unchanged."""
        found = set()
        for offset, seed in self.seeds:
            at = words.find(seed)
            while at >= 0:
                found.add(at - offset)
                at = words.find(seed, at + 1)
        return found

    def candidates(self, words: bytes) -> dict[tuple[int, int], int]:
        """Edits of each (start, end) that is the notice with few enough of them."""
        found, size = {}, len(self.text)
        whole = b" " + self.telling + b" "
        for origin in self.origins(words):
            end = origin + size
            if origin >= 0 and words[origin:end] == self.text:
                found[origin, end] = 0
                continue
            low, high = max(0, origin - self.edits), min(len(words), end + self.edits)
            if not self.quick.search(words, low, high):
                continue
            # Edits before the seed move the start, those behind it the end.
            for i in range(-self.edits, self.edits + 1):
                for j in range(abs(i) - self.edits, self.edits - abs(i) + 1):
                    span = origin + i, end + j
                    if span in found or span[0] < 0 or span[1] > len(words):
                        continue
                    if self.telling and words.find(whole, max(0, span[0] - 1), span[1] + 1) < 0:
                        continue
                    match = self.pattern.fullmatch(words, *span)
                    if match:
                        found[span] = sum(match.fuzzy_counts)
        return found

    def spans(self, words: bytes) -> list[tuple[int, int, int]]:
        """(start, end, edits) of each occurrence: of spans that overlap the one with the fewest
        edits, of these one between spaces, of these the first. Two may share a space."""
        space = b" "[0]

        def rank(item: tuple[tuple[int, int], int]) -> tuple:
            (start, end), edits = item
            return edits, (words[start] != space) + (words[end - 1] != space), start, end

        def apart(left: tuple, right: tuple) -> bool:
            shared = min(left[1], right[1]) - right[0]
            return shared <= 0 or (shared == 1 and words[right[0]] == space)

        found: list[tuple[int, int, int]] = []
        for (start, end), edits in sorted(self.candidates(words).items(), key=rank):
            one = (start, end, edits)
            k = bisect(found, one)
            if (k == 0 or apart(found[k - 1], one)) and (k == len(found) or apart(one, found[k])):
                found.insert(k, one)
        return found


def notice(label: str, text: str, telling: str = "") -> Notice:
    """A notice of plain words, lower-cased; `telling` must stand in a match unchanged."""
    return Notice(label, f" {text} ".encode(), min(3, len(text) // 10), telling.encode())


SOUGHT = [notice(*n) for n in NOTICES]


def known(given: list[tuple[str, str, str]]) -> list[Notice]:
    return SOUGHT if given == NOTICES else [notice(*n) for n in given]


def places(words: bytes, phrase: str) -> list[int]:
    """Every place of a phrase, in bytes, in words that are enclosed by spaces."""
    sought, found = f" {phrase} ".encode(), []
    at = words.find(sought)
    while at >= 0:
        found.append(at)
        at = words.find(sought, at + 1)
    return found


def scan(text: str, sought: list[Notice] = SOUGHT, phrases: dict[str, str] = PHRASES) -> dict:
    """Words, exact places and notices of a text; places and spans count words from 0."""
    words = plain_words(text)
    joined = b" " + b" ".join(words) + b" "
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20).tolist()

    def before(at: int) -> int:
        """Spaces before a place."""
        return bisect_left(spaces, at)

    base = [(before(at), label) for p, label in phrases.items() for at in places(joined, p)]
    spans, score = [], 1.0 if base else 0.0
    for one in sought:
        for start, end, edits in one.spans(joined):
            score = max(score, 1 - edits / len(one.text))
            first = before(start + 1) - 1
            last = before(max(start + 1, end - 1)) - 1
            spans.append({"label": one.label, "first": max(0, first), "last": max(0, last), "edits": edits})
    return {"words": len(words), "base": base, "spans": spans, "score": score}


def notices(docs: DataFrame, sought: list[tuple[str, str, str]] = NOTICES) -> DataFrame:
    """doc_id and spans: label, first and last word and edits of each notice found.

    `sought` are triples of label, words, and words that must stand in a match unchanged.
    """
    item = T.StructType(
        [T.StructField("label", T.StringType())]
        + [T.StructField(c, T.IntegerType()) for c in ("first", "last", "edits")]
    )
    kind = pa.list_(
        pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("edits", pa.int32())])
    )

    def run(texts: list[str]) -> list:
        mine = known(sought)
        return [[scan(t, mine)["spans"] for t in texts]]

    return map_texts(id_and_text(docs), run, [("spans", kind, T.ArrayType(item))])


def labels(
    docs: DataFrame,
    sought: list[tuple[str, str, str]] = NOTICES,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """n_words, places and labels of the exact phrases, all labels and a score for every row."""

    def run(texts: list[str]) -> list:
        out = []
        mine = known(sought)
        for text in texts:
            found = scan(text, mine, phrases)
            starts = [at for at, _ in found["base"]]
            base = {label for _, label in found["base"]}
            every = base | {s["label"] for s in found["spans"]}
            ends = (min(starts), max(starts)) if starts else (None, None)
            joined = ",".join(sorted(base)), ",".join(sorted(every))
            out.append((found["words"], len(starts), *ends, *joined, found["score"]))
        return list(zip(*out)) or [[]] * 7

    fields = [(c, pa.int64(), T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    fields += [(c, pa.string(), T.StringType()) for c in ("base_labels", "labels")]
    return map_texts(id_and_text(docs), run, [*fields, ("score", pa.float64(), T.DoubleType())])

import random
import re
import time

import pytest
import regex
from corpus import AWKWARD, docs

from orderloom.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = [
        (k, label)
        for phrase, label in licenses.PHRASES.items()
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    starts = [k for k, _ in places]
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted({x for _, x in places}))


TEXTS = [
    "Released under the MIT License.",
    "CC-BY-NC, cc by nc by nc; Under The\nMIT license under the mit license",
    "Apache License, Version 2.0 é Apache©License version 2",
    "no licence ﬁ here",
]


def test_exact_places_against_plain_scan(spark):
    rows = AWKWARD + [(100 + k, t) for k, t in enumerate(TEXTS)]
    rows += [(200 + k, " ".join(random.Random(k).choice(["cc", "by", "nc", "under", "the", "mit", "license"]) for _ in range(200))) for k in range(20)]
    got = licenses.labels(docs(spark, rows)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(((i, *plain(t)) for i, t in rows), key=str)
    for r in got:
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)
    assert licenses.labels(docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_edited_notices_against_matching_without_seeds(seed):
    """Wherever matching over the whole text finds a notice, the search by seeds finds it."""
    rng = random.Random(seed)
    for one in licenses.SOUGHT:
        for _ in range(20):
            text = bytearray(one.text)
            for _ in range(rng.randrange(one.edits + 2)):
                k = rng.randrange(1, len(text) - 1)
                kind = rng.randrange(3)
                if kind == 0:
                    text[k] = rng.choice(b"abcxyz")
                elif kind == 1:
                    del text[k]
                else:
                    text.insert(k, rng.choice(b"abcxyz"))
            filler = b" " + b" ".join(rng.choice([b"foo", b"license", b"the", b"under"]) for _ in range(30))
            whole = filler + bytes(text) + filler + b" "
            pattern = regex.compile(b"(?b)(?:" + regex.escape(one.text) + b"){e<=" + str(one.edits).encode() + b"}")
            found = [m for m in pattern.finditer(whole) if not one.telling or one.telling in m[0].split()]
            assert bool(found) == bool(one.spans(whole))


def test_typing_errors_are_reported(spark):
    rows = [(1, "Released undr the MIT Licence by me"), (2, "GNU Genral Public License, version 3"), (3, "gnu general public license version 4")]
    found = {r.doc_id: r.spans for r in licenses.notices(docs(spark, rows)).collect()}
    assert [(s.label, s.first, s.last, s.edits) for s in found[1]] == [("mit", 1, 4, 2)]
    assert [(s.label, s.edits) for s in found[2]] == [("gpl-3", 1)]
    assert found[3] == []


def test_a_better_notice_does_not_hide_others():
    def found(text):
        return [(s["label"], s["first"], s["edits"]) for s in licenses.scan(text)["spans"]]

    wrong = "gnu generl publc license version 2"
    assert found(wrong) == [("gpl-2", 0, 2)]
    assert found(f"{wrong} or gnu general public license version 3") == [("gpl-3", 7, 0), ("gpl-2", 0, 2)]
    assert found(f"gnu general public license version 3 or {wrong}") == [("gpl-3", 0, 0), ("gpl-2", 7, 2)]
    assert found("gnu general public license version 25") == []
    for text in ("all rights reservd all rights reserved", "all rights reserved all rights reservd"):
        assert sorted(e for _, _, e in found(text)) == [0, 1]
        assert [first for _, first, _ in found(text)] == [0, 3]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("seed", range(3))
def test_spans_against_every_span(seed):
    """Spans with few enough edits that hold the telling word, all of them, by edit distance."""
    rng = random.Random(seed)
    for one in licenses.SOUGHT:
        text = bytearray(one.text + one.text[1:])
        for _ in range(rng.randrange(2 * one.edits + 1)):
            k = rng.randrange(1, len(text) - 1)
            text[k : k + rng.randrange(2)] = rng.choice([b"", b"x", b"2", b" 3"])
        whole = b" foo" + bytes(text) + b"bar "
        every = {
            (a, b): d
            for a in range(len(whole))
            for b in range(a + len(one.text) - one.edits, min(len(whole), a + len(one.text) + one.edits) + 1)
            if (not one.telling or b" " + one.telling + b" " in whole[max(0, a - 1) : b + 1])
            and (d := distance(one.text, whole[a:b])) <= one.edits
        }
        spans = one.spans(whole)
        assert all(every[a, b] == d for a, b, d in spans)
        assert all(x[1] <= y[0] + 1 for x, y in zip(spans, spans[1:]))
        for (a, b), d in every.items():
            assert any(x < b and a < y and e <= d for x, y, e in spans)


def test_other_notices_and_phrases(spark):
    rows = [(1, "Sold as is, whithout any warranty at all."), (2, "Under the MIT license; do not copy")]
    sought = [("as-is", "sold as is without any warranty", "warranty")]
    found = {r.doc_id: r for r in licenses.labels(docs(spark, rows), sought, {"do not copy": "closed"}).collect()}
    assert (found[1].labels, found[1].base_labels, found[1].score < 1) == ("as-is", "", True)
    assert (found[2].labels, found[2].base_labels, found[2].first_word) == ("closed", "closed", 4)
    assert licenses.notices(docs(spark, rows), sought).filter("size(spans) = 1").count() == 1


def test_time_follows_the_text():
    """Ten times the hits take about ten times as long, not a hundred times."""
    one = "Licensed under the Apache License, Version 2.0 and all rights reserved. "
    took = []
    for times in (2_000, 20_000):
        start = time.perf_counter()
        found = licenses.scan(one * times)
        took.append(time.perf_counter() - start)
        assert len(found["base"]) == times
    assert took[1] < 30 * took[0]

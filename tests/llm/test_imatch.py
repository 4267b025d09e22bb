import hashlib

import pytest
from corpus import AWKWARD, docs

from orderloom.llm import imatch


def expected(rows):
    """Edited texts by the order of ids alone (ids without repeats)."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, t), (_, follow) in zip(ordered, ordered[1:] + ordered[:1]):
        t, follow = t or "", follow or ""
        n = len(t) // 3
        out[i] = (len(t), hashlib.sha256((t[: len(t) - n] + follow[:n]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("n", [1, 2, 50, 400])
def test_edited_texts_of_the_next_document(spark, n):
    rows = [(7 * k - 100, f"text {k} é😀 " * (k % 9)) for k in range(n)]
    got = imatch.edit_digests(docs(spark, rows)).collect()
    assert len(got) == n
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == expected(rows)


def test_fingerprints_against_plain_form(spark):
    rows = [(k, " ".join(f"w{(k * j) % 97}" for j in range(1, 60)) + f" only{k}") for k in range(60)]
    rows += [(100 + k, rows[k][1]) for k in range(5)]
    table = docs(spark, rows)
    by_text = {}
    frequency = {}
    for _, t in rows:
        for w in set(t.split()):
            frequency[w] = frequency.get(w, 0) + 1
    inside = {w for w, n in frequency.items() if n * imatch.COMMONEST <= len(rows)}
    bits = bytearray(1 << (imatch.MAP_BITS - 3))
    for w in inside:
        place = imatch.term_hash(w.encode()) >> (64 - imatch.MAP_BITS)
        bits[place >> 3] |= 1 << (place & 7)
    assert imatch.lexicon(table) == bytes(bits)
    for r in imatch.fingerprints(table).collect():
        t = dict(rows)[r.doc_id]
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        terms = sorted(imatch.term_hash(w.encode()) for w in set(t.split()) & inside)
        whole = b"".join(x.to_bytes(8, "little") for x in terms)
        assert r.fingerprint[:16] == imatch.xxhash.xxh64_hexdigest(whole)
    assert len(set(by_text.values())) == len(by_text)


def test_edits_are_nearer_than_other_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = imatch.edit_digests(table).collect()
    assert len(rows) == table.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sum(r.near_edited > r.near_next for r in rows) > 0.85 * len(rows)


def test_awkward_rows(spark):
    got = imatch.edit_digests(docs(spark, AWKWARD)).collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(i) for i, _ in AWKWARD)
    texts = {}
    for r in got:
        texts.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in texts.values())
    assert imatch.edit_digests(docs(spark, [])).count() == 0


def test_near_copies_of_a_third_of_the_table(spark):
    """A group's words stand in a third of the rows, and still tell its near copies."""
    rows = [(k, " ".join(f"own{k}x{j}" for j in range(40))) for k in range(200)]
    group = [f"shared{j}" for j in range(60)]
    rows += [(1000 + k, " ".join([*group[: k % 60], *group[k % 60 + 1 :]])) for k in range(100)]
    marks = {r.doc_id: r.fingerprint for r in imatch.fingerprints(docs(spark, rows)).collect()}
    near = [imatch.likeness(marks[1000 + k], marks[1001 + k]) for k in range(59)]
    assert min(near) > 0.5
    assert max(imatch.likeness(marks[k], marks[k + 1]) for k in range(199)) == 0


@pytest.mark.parametrize("n", [1_000, 4_000, 20_000, 100_000])
def test_near_copies_of_very_long_texts(spark, n):
    """However many terms a text has, some subsets hold few enough to outlast an edit of a third."""
    rows = [(k, " ".join(f"t{k}x{j}" for j in range(n))) for k in range(6)]
    got = imatch.edit_digests(docs(spark, rows)).collect()
    assert len(got) == 6
    assert all(r.near_edited > 0 for r in got)
    assert all(r.near_next == 0 for r in got)


@pytest.mark.parametrize("n", [1, 3, 200])
def test_ids_that_are_text(spark, n):
    """Ordered as text, a null id last; the last document's next is the first."""
    rows = [(f"id-{(37 * k) % 1009}", f"text {k} é " * (k % 7)) for k in range(n)] + [(None, "without id")]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    ordered = sorted(rows[:-1], reverse=True) + rows[-1:]
    want = {}
    for (i, t), (_, follow) in zip(ordered, ordered[1:] + ordered[:1]):
        third = len(t) // 3
        want[i] = hashlib.sha256((t[: len(t) - third] + follow[:third]).encode()).hexdigest()
    assert {r.doc_id: r.edited_sha256 for r in imatch.edit_digests(frame).collect()} == want

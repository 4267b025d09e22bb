"""Names of other columns that operators might use themselves: all columns and values stay."""

from corpus import docs
from pyspark.sql import functions as F

from orderloom.llm import secrets, simhash, suffixes

NAMES = ["_row", "_spans", "_SPANS_", "_mark", "_id", "_key", "mark_", "of", "KEY", "row_", "spans_", "Mark__", "wide", "low"]
PASSAGE = " ".join(f"passage{k}" for k in range(60))
ROWS = [
    (1, f"a {PASSAGE}"), (2, f"{PASSAGE} b"), (3, "token = live9live8live7"), (4, None), (5, ""),
    (6, "the very same words"), (7, "the very same words"), (None, "no id"),
]


def frame(spark):
    made = docs(spark, ROWS)
    for k, name in enumerate(NAMES):
        made = made.withColumn(name, F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return made


def others(df):
    return {r["doc_id"]: [r[c] for c in df.columns if c not in ("text", "n_chars")] for r in df.collect()}


def test_columns_and_values_stay(spark):
    given = frame(spark)
    want = others(given)
    for operator in (secrets.redact, simhash.one_of_each, suffixes.remove_repeats):
        found = operator(given)
        assert found.dtypes == given.dtypes
        got = others(found)
        assert got == {k: want[k] for k in got}
    assert len(others(simhash.one_of_each(given))) == len(ROWS) - 2
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(given).collect()}
    assert masked[3] == "[secret]" and masked[4] is None and masked[6] == "the very same words"
    cut = {r["doc_id"]: r["text"] for r in suffixes.remove_repeats(given).collect()}
    assert cut[1].strip() == "a" and cut[2].strip() == "b" and cut[6] == "the very same words"

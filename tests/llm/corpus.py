"""Small frames with the cases every operator must handle."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        *[T.StructField(c, T.StringType()) for c in ("fp", "mark", "row", "ids", "spans", "start", "bucket")],
    ]
)
LABELS = T.StructType(
    [T.StructField(c, T.LongType() if c == "doc_id" else T.IntegerType()) for c in ("doc_id", "quality", "toxic")]
)


def docs(spark, rows):
    """Rows (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "s", None, *["x"] * 7) for r in rows]
    return spark.createDataFrame(full, DOCS)


AWKWARD = [
    (0, None),
    (1, ""),
    (2, "   \n\t "),
    (None, "a text with a null id"),
    (3, "same text twice"),
    (3, "same text twice"),
    (4, "same text twice"),
    (5, "Ünïcödé ☃ 😀 text\x00with odd signs <|endoftext|> x"),
    (-7, "negative id"),
    (6, "word " * 30_000),
]

"""What the operators share: reading tables, and running a function over the texts of a frame."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts handed to a function at once: bounds what a task holds besides one Arrow batch.
SLICE_CHARS = 4_000_000


PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, unless their path has it already."""
    context, home = spark.sparkContext, PACKAGE.parent
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if any(p and Path(p).resolve() == home for p in paths) or getattr(context, "_ships", "") == str(home):
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(), PACKAGE.name), "zip", home, PACKAGE.name
    )
    context.addPyFile(archive)
    context._ships = str(home)


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{root}/{table}.parquet")


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names like these that are not taken; names that differ in case alone are the same."""
    known = {c.lower() for c in taken}
    found = []
    for name in names:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        found.append(name)
    return found


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators use, under fixed names; a null text is empty."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def id_type(docs: DataFrame, id_col: str = "doc_id") -> T.DataType:
    return docs.schema[id_col].dataType


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_CHARS bytes of text each, one row at least."""
    sizes = batch.column(column).nbytes / max(1, batch.num_rows)
    step = max(1, int(SLICE_CHARS / max(1.0, sizes)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def map_texts(
    texts: DataFrame,
    function: Callable[[list[str]], list],
    fields: list[tuple[str, pa.DataType, T.DataType]],
) -> DataFrame:
    """`texts` (doc_id, text) with the text replaced by the columns the function returns for it.

    The function gets a list of texts and returns a list of values for each field.
    """
    schema = T.StructType(
        [T.StructField("doc_id", texts.schema["doc_id"].dataType)]
        + [T.StructField(name, kind) for name, _, kind in fields]
    )
    names = ["doc_id"] + [name for name, _, _ in fields]
    kinds = [kind for _, kind, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values = function(part.column("text").to_pylist())
                arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=names)

    return texts.select("doc_id", "text").mapInArrow(run, schema)


def is_held_out(doc_id: Column) -> Column:
    """Whether labels of the document are kept from training: crc32 of its id leaves 2 mod 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]
) -> tuple[list[tuple[int, str]], float]:
    """A bounded sample of labelled texts outside the held-out rows, and the share of label 1.

    `per_class` documents the bound: so many documents of each class at most, those with the
    smallest hashed ids. Of repeated ids one text counts.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .filter(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    order = F.xxhash64("doc_id")
    parts = [
        known.filter(F.col("label") == k).orderBy(order, "doc_id").limit(n)
        for k, n in sorted(per_class.items())
    ]
    sample = parts[0]
    for part in parts[1:]:
        sample = sample.unionByName(part)
    rows = (
        id_and_text(docs)
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    return [(int(r["label"]), r["text"]) for r in rows], share


# Fixed value: the bytes of words are 0-9, a-z (A-Z in lower case) and all from 0x80 on.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def plain_words(text: str) -> list[bytes]:
    """Words of ASCII letters, in lower case, digits, and all code points from 0x80 on."""
    return text.encode().translate(WORD_BYTES).split()

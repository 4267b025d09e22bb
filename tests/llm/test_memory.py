"""What stages of the pipeline hold at once: small parts of a batch, and no workers besides those of the texts."""

import numpy as np
import pyarrow as pa
import public_tokenizers
from corpus import docs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orderloom.llm import packing, suffixes, toxicity
from orderloom.llm.common import SLICE_CHARS

SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


class Mapped:
    """Stands for a frame: gives the function that is mapped over its batches."""

    columns = SCHEMA.names
    schema = None

    def mapInArrow(self, function, schema):  # noqa: N802
        self.function = function
        return self

    def select(self, *columns):
        return self


def batch():
    texts = [None, "", *["some words of a text " * 50_000] * 12]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], schema=SCHEMA)


def test_clean_texts_leave_in_parts():
    frame, given = Mapped(), batch()
    model = toxicity.Model(np.zeros(1 << toxicity.BITS, np.float32), -9.0)
    toxicity.keep_clean(frame, model)
    parts = list(frame.function([given]))
    assert max(p.nbytes for p in parts) < 2 * SLICE_CHARS < given.nbytes
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([given]))


def test_cut_texts_leave_in_parts(monkeypatch):
    frame, given = Mapped(), batch()
    spans = pa.array([None] * given.num_rows, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))
    monkeypatch.setattr(suffixes, "covered", lambda *a: frame)
    suffixes.remove_repeats(frame)
    parts = list(frame.function([given.append_column("spans", spans)]))
    assert max(p.nbytes for p in parts) < 2 * SLICE_CHARS
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([given]))


def test_plan_of_packing_needs_no_workers(spark, monkeypatch):
    made, create = [], type(spark).createDataFrame

    def noted(self, data, *args, **kwargs):
        made.append(type(data))
        return create(self, data, *args, **kwargs)

    rows = docs(spark, [(1, "some text " * 3000), (2, None), (3, "more")])
    monkeypatch.setattr(SparkSession, "createDataFrame", noted)
    found = packing.pack(rows, public_tokenizers.path("word_bpe_49k.json"))
    assert made == [pa.Table]
    assert found.agg(F.sum("length")).first()[0] == found.select("doc_id", "doc_tokens").distinct().agg(
        F.sum("doc_tokens")
    ).first()[0]

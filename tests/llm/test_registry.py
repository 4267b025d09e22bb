"""The registered queries over the small test tables, and SQL where there is any."""

import duckdb
import pytest

import corpus_pipeline
from orderloom.llm import registry

ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    got = registry.QUERIES[name](spark, ROOT)
    want = db.execute(registry.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


COLUMNS = {
    "op1_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op2_imatch": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double",
    "op3_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
    "n_repeated bigint, kept_sha256 string",
    "op4_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op5_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint",
    "op6_licenses": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double",
    "op7_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_conversations": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op12_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op13_ranked": "item_id bigint, rank int, doc_id bigint, score bigint",
}


def test_columns(spark):
    for name, query in registry.QUERIES.items():
        assert ", ".join(" ".join(f) for f in query(spark, ROOT).dtypes) == COLUMNS[name], name


def test_stages_are_the_run(spark):
    """run() gives what the stages give one after the other, and all but the last keep the columns."""
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns = docs.dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "suffix_dedup", "secrets", "packing",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, ROOT)
        assert docs.dtypes == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT)
    compared = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = corpus_pipeline.run(spark, ROOT)
    tokens = lambda df: sorted({(r.doc_id, r.doc_tokens) for r in df.select("doc_id", "doc_tokens").collect()})
    assert tokens(whole) == tokens(last) and whole.columns[:5] == compared

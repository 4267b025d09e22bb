"""The registered queries of these operators, over whole tables, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    bpe,
    conversations,
    imatch,
    language,
    licenses,
    packing,
    quality,
    ranked,
    secrets,
    simhash,
    suffixes,
    topk,
    toxicity,
)
from orderloom.llm.common import read


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, root: str) -> DataFrame:
    return topk.top_k(read(spark, root, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_imatch(spark: SparkSession, root: str) -> DataFrame:
    return imatch.edit_digests(read(spark, root, "documents"))


def op3_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    return suffixes.removal_digests(read(spark, root, "documents"), passage=suffixes.PASSAGE)


def op4_secrets(spark: SparkSession, root: str) -> DataFrame:
    return secrets.span_digests(read(spark, root, "documents"))


def op5_packing(spark: SparkSession, root: str) -> DataFrame:
    return piece_digests(read(spark, root, "documents"))


def piece_digests(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_licenses(spark: SparkSession, root: str) -> DataFrame:
    return licenses.labels(read(spark, root, "documents"))


def op7_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality.classify(read(spark, root, "documents"), read(spark, root, "labels"))


def op8_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.classify(read(spark, root, "documents"), read(spark, root, "labels"))


def op9_bpe(spark: SparkSession, root: str) -> DataFrame:
    return bpe.digests(read(spark, root, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_simhash(spark: SparkSession, root: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, root, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op11_conversations(spark: SparkSession, root: str) -> DataFrame:
    return conversations.repair_digests(read(spark, root, "conversations"))


def op12_language(spark: SparkSession, root: str) -> DataFrame:
    return language.identify(read(spark, root, "documents"))


def op13_ranked(spark: SparkSession, root: str) -> DataFrame:
    return ranked.rank_documents(read(spark, root, "documents"), read(spark, root, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_imatch": op2_imatch,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secrets": op4_secrets,
    "op5_packing": op5_packing,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_simhash": op10_simhash,
    "op11_conversations": op11_conversations,
    "op12_language": op12_language,
    "op13_ranked": op13_ranked,
}

ORACLES: dict[str, str] = {
    "op13_ranked": ranked.ORACLE,
    "op4_secrets": secrets.ORACLE,
    "op1_topk": """
        WITH good AS (
            SELECT row_number() OVER () AS row_no, vec_id,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT q.row_no, q.vec_id AS query_id, c.vec_id,
                   list_inner_product(q.v, c.v)::BIGINT AS score
            FROM good q JOIN good c ON q.row_no <> c.row_no AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS rank
            FROM pairs)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
}

"""The corpus pipeline: toxicity, near-duplicates, repeated passages, secrets, packing.

Each stage takes the rows its predecessor kept, reread from Parquet, and decides on them alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import secrets, simhash, suffixes, toxicity
from orderloom.llm.common import read
from orderloom.llm.registry import piece_digests
from orderloom.sources.shared import keep

# A stage of the driver's check is called with (spark, docs, sf_dir).
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier does not reject, unchanged."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand elsewhere too are cut out of the texts.

    Those of PASSAGE bytes or more, which any passage of over 50 words has.
    """
    return suffixes.remove_repeats(docs, suffixes.PASSAGE)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, unless so many owners have them that they are copied examples."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document and where they go."""
    return piece_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Classifiers, bit fingerprints and packing can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

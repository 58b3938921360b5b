"""The corpus pipeline: documents without toxic texts, near copies and repeated paragraphs, mixed to
target weights and tokenised.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and reread as the next
one's docs. All but the last return the columns of ``documents``. Missing texts are empty texts to
every stage, empty tables give empty results, and further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm import bpe, mixing, paragraphs, simhash, toxicity
from riskstream.llm.common import small_batches, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def lean(stage: Stage) -> Stage:
    """``stage`` with few rows in Python at a time: the stages' Python workers live on beside each other."""
    @wraps(stage)
    def with_small_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return with_small_batches


@lean
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity score of 0.3 or more; it learns as ``op2_toxicity`` does."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@lean
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id: four-word SimHash
    fingerprints within 4 bits, as in ``op3_simhash``."""
    return simhash.drop_near_copies(docs)


@lean
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of (nearly) equal paragraphs and of passages are cut from the texts; n_chars follows."""
    cut = paragraphs.drop_repeated_paragraphs(docs)
    if "n_chars" not in cut.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@lean
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


@lean
def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the number of tokens and the digests of the ids and of the decoded text."""
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("paragraphs", without_repeats),
    ("mixing", mixed),
    ("bpe", tokenised),
]

#: A trained model, near-copy components and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

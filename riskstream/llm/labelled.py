"""What the two classifiers share: the bounded sample of labelled rows and the split by document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import written

#: Labelled rows that a classifier learns from, about this many at most: chosen by a hash of the id.
SAMPLE = 12_000
_STEPS = (1 << 63) - 1


def id_fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids have none."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def held_out(folds: int, fold: int) -> Column:
    """Rows without an id are never learned from, so they count as held out."""
    return F.coalesce(id_fold(folds) == fold, F.lit(True))


def chosen_by_hash(rows: int, of: int) -> Column:
    """True for about ``rows`` of ``of`` ids, whatever their number: all bits of a hash are compared."""
    limit = _STEPS if of <= rows else rows * _STEPS // of
    return F.xxhash64("doc_id", F.lit("sample")).bitwiseAND(F.lit(_STEPS)) <= F.lit(limit)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int = SAMPLE) -> DataFrame:
    """(doc_id, text, label) of about ``rows`` labelled rows at most, none of them of the held-out fold.

    Of several labels for one id the largest counts; null labels and null ids are left out. The sample
    is a stored table, so that it is broadcast by its size and the texts need not be moved.
    """
    known = (labels.select("doc_id", F.col(label).cast("double").alias("label"))
             .where(F.col("label").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & (id_fold(folds) != fold))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    chosen = written(known.where(chosen_by_hash(rows, known.count())), "labels")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return written(texts.join(chosen, "doc_id").select("doc_id", "text", "label"), "sample")

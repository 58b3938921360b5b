"""Importance resampling: documents drawn by how much likelier a target makes their hashed word runs.

An untrained ``tokenizers`` Split over the ASCII-lowered text gives the words with their offsets.
Pairs of offsets, a window over them, cut each run of words out of the text; its CRC is its bucket.
The buckets of a document are kept as packed numbers, so that each text is split once: they are summed
to one histogram over all documents, and once its logarithmic gains over the target's histogram
are known, summed again to the document's weight. Weights get Gumbel noise from a digest of the id,
and the highest are drawn, which samples without replacement in proportion to likelihood.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from riskstream.llm.common import written

#: A word, hash buckets, units of a gain, seed of the noise, words of a document that may be drawn.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, UNITS, SEED, LEAST = 10_000, 1000, 7, 20
#: Drawn share in per cent.
SHARE = 25
#: Bytes that are split at once; longer texts are cut between words.
PART = 1 << 10
#: Neighbouring scores that share a row of the coarse table.
COARSE = 256
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


@lru_cache(maxsize=1)
def splitter() -> pre_tokenizers.Split:
    return pre_tokenizers.Split(Regex(PATTERN), behavior="removed", invert=True)


def parts(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about ``PART`` bytes that begin outside of words; one word is one piece."""
    start = 0
    while len(data) - start > PART:
        cut = _BETWEEN.search(data, start + PART)
        if cut is None:
            break
        yield data[start:cut.start()]
        start = cut.start()
    yield data[start:] if start else data


def feature_buckets(text: str) -> tuple[int, np.ndarray]:
    """The number of words of ``text``, and the bucket of each run of one and of two words.

    The Split sees each byte of the UTF-8 as one letter: those of longer code points belong to words, as
    the code points do, and offsets count bytes.
    """
    count, last, found = 0, None, []
    for data in parts(text.encode("utf-8", "surrogatepass").lower()):
        spans = [span for _, span in splitter().pre_tokenize_str(data.decode("latin-1"))]
        if not spans:
            continue
        single = [crc32(data[a:b]) for a, b in spans]
        found += single
        if last is not None:
            found.append(crc32(b" " + data[spans[0][0]:spans[0][1]], last))
        found += [crc32(data[b:d] if c == b + 1 and data[b] == 32 else b" " + data[c:d], crc)
                  for crc, (_, b), (c, d) in zip(single, spans, spans[1:])]  # a sum goes on where the first word ended
        last = single[-1]
        count += len(spans)
    return count, (np.array(found, dtype=np.int64) % BUCKETS).astype("<u2")


@F.pandas_udf(T.StructType([T.StructField("words", T.LongType()), T.StructField("buckets", T.BinaryType())]))
def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = [(count, buckets.tobytes()) for count, buckets in map(feature_buckets, batch)]
        yield pd.DataFrame(rows, columns=["words", "buckets"], index=batch.index)


def histogram(rows: DataFrame) -> DataFrame:
    """(bucket, n) over all ``rows`` (buckets): each task sends one row per bucket at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, dtype="<u2"), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    return rows.select("buckets").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain) for each of the ``BUCKETS`` buckets, from two histograms."""
    joined = (source.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
              .join(source.select("bucket", F.col("n").alias("s")), "bucket", "left")
              .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left").fillna(0, ["s", "t"]))
    all_s, all_t = joined.agg(F.sum("s"), F.sum("t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1.0) * (F.lit(float(all_s)) + float(BUCKETS)) / ((s + 1.0) * (F.lit(float(all_t)) + float(BUCKETS)))
    return joined.select("bucket", F.floor(F.lit(float(UNITS)) * F.log(ratio)).alias("gain"))


def scored_documents(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, words, n_features, weight, score) per row of ``docs`` (doc_id, text); ``target`` (text)."""
    def packed(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(*columns, hashed(F.coalesce("text", F.lit(""))).alias("h")).select(*columns, "h.*")

    rows = written(packed(docs, "doc_id"), "resample")
    found = bucket_gains(written(histogram(rows), "resample"), written(histogram(packed(target)), "resample"))
    table = found.orderBy("bucket").collect()  # BUCKETS rows, whatever the input
    gains = np.array([r.gain for r in table], dtype=np.int64)

    @F.pandas_udf("long")
    def weight(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            kept = [np.frombuffer(packed, dtype="<u2") for packed in batch]
            yield pd.Series([int(gains[b].sum()) // len(b) if len(b) else 0 for b in kept], dtype="int64", index=batch.index)

    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-float(UNITS)) * F.log(-F.log((drawn.cast("double") + 0.5) / 4294967296.0)))
    return (rows.select("doc_id", "words", (F.octet_length("buckets") / 2).cast("long").alias("n_features"), weight("buckets").alias("weight"))
            .withColumn("score", F.col("weight") + noise))


def ranked_above(scored: DataFrame, share: int) -> DataFrame:
    """``scored`` with rank: 1, 2, 3... of the highest ``share`` per cent of the rows with ``LEAST`` words
    or more, null of all others.

    Scores are whole numbers in a bounded range, so their counts are a small table; its running sums,
    coarse ones first, give the rank that each score begins at, and only rows of one score are ordered.
    """
    may = scored.where(F.col("words") >= LEAST)
    counts = written(may.groupBy("score").agg(F.count("*").alias("n")).withColumn("coarse", F.floor(F.col("score") / COARSE)), "scores")
    most = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * share // 100
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    coarse = (counts.groupBy("coarse").agg(F.sum("n").alias("n"))
              .select("coarse", F.coalesce(F.sum("n").over(before.orderBy(F.desc("coarse"))), F.lit(0)).alias("above")))
    inside = F.coalesce(F.sum("n").over(before.partitionBy("coarse").orderBy(F.desc("score"))), F.lit(0))
    begin = written(counts.join(coarse, "coarse").select("score", (F.col("above") + inside).alias("begin")).where(F.col("begin") < most), "scores")
    lowest = begin.agg(F.min("score")).first()[0]
    high = (F.col("words") >= LEAST) & (F.lit(lowest).cast("long") <= F.col("score"))
    high = F.coalesce(high, F.lit(False))
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight"))
    rank = (F.col("begin") + place).cast("long")
    chosen = (scored.where(high).join(begin, "score").withColumn("rank", rank)
              .withColumn("rank", F.when(F.col("rank") <= most, F.col("rank"))))
    return chosen.select(*scored.columns, "rank").union(scored.where(~high).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of ``docs`` (doc_id, text), drawn towards ``target`` (text).

    Missing texts are empty: no features, weight 0, never drawn. Whole texts count, however long.
    A missing id has noise of its own (that of an empty id) and comes last among equal scores;
    repeated rows are drawn one by one, next to each other. Empty tables give empty results, an empty
    target gives every bucket its gain over nothing. Further columns are not looked at.
    """
    scored = written(scored_documents(docs, target), "resample")
    return ranked_above(scored, share).drop("words")


def drawn_documents(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """The drawn rows of ``docs`` (doc_id, text, ...) themselves, with all their columns. Ids must be unique:
    of rows that share an id, all come if one is drawn."""
    chosen = resample(docs, target, share).where("rank is not null").select("doc_id").distinct()
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")

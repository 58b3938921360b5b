"""Context-triggered piecewise hashing (Kornblum 2006): a rolling hash over the last bytes cuts the
text where its value meets the block size, each chunk gives one character, and two signatures are
compared by edit distance if their block sizes are equal or one step apart."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import written

#: Bytes under the rolling hash, smallest block size, chunks aimed at, and digits.
WINDOW, LEAST_BLOCK, CHUNKS = 5, 2, 64
DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
ROLL, CHUNK = 0x9E3779B1, 0x100000001B3


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0x2C1B3C6D)
    return x ^ (x >> np.uint32(12))


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last ``WINDOW`` bytes up to each byte; those before the text count as zero."""
    out = np.zeros(len(data), dtype=np.uint32)
    for back in range(min(WINDOW, len(data))):
        factor = np.uint32(pow(ROLL, back + 1, 1 << 32))
        out[back:] += (data[: len(data) - back].astype(np.uint32) + np.uint32(1)) * factor
    return _mixed(out)


def _signature(data: np.ndarray, cuts: np.ndarray) -> str:
    """One digit for each chunk; ``cuts``: the places of the chunks' last bytes."""
    starts = np.concatenate(([0], cuts + 1))
    starts = starts[starts < len(data)]
    if not len(starts):
        return ""
    place = np.arange(len(data), dtype=np.uint64)
    place -= np.repeat(place[starts], np.diff(np.append(starts, len(data))))
    spread = (data.astype(np.uint64) + np.uint64(1)) * ((place + np.uint64(1)) * np.uint64(CHUNK) ^ (place << np.uint64(17)))
    sums = np.add.reduceat(spread ^ (spread >> np.uint64(23)), starts)
    sums = (sums ^ (sums >> np.uint64(29))) * np.uint64(CHUNK)
    return DIGITS[((sums >> np.uint64(40)) & np.uint64(63)).astype(np.int64)].tobytes().decode()


def text_signature(text: str | None) -> str:
    """``block size:signature:signature at twice the block size``.

    The block size is the smallest power-of-two multiple of ``LEAST_BLOCK`` at which the text gives at
    most ``CHUNKS`` chunks, so signatures are short for any text, and no part of it is left out.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    block = LEAST_BLOCK
    while block * CHUNKS < len(data):
        block *= 2
    hashes = _rolling(data)
    at = np.flatnonzero(hashes % np.uint32(block) == block - 1)
    while len(at) >= CHUNKS:
        block *= 2
        at = at[hashes[at] % np.uint32(block) == block - 1] if block < 1 << 31 else at[:0]
    twice = at[hashes[at] % np.uint32(2 * block) == 2 * block - 1] if block < 1 << 30 else at[:0]
    return f"{block}:{_signature(data, at)}:{_signature(data, twice)}"


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: one less the edit distance over the longer signature, at the block size that both
    have; 0 if they have none in common. Equal fingerprints are 1."""
    x, y = F.split(a, ":"), F.split(b, ":")
    bx, by = x[0].cast("long"), y[0].cast("long")

    def alike(s: Column, t: Column) -> Column:
        longer = F.greatest(F.length(s), F.length(t))
        return F.when(longer == 0, 0.0).otherwise(1.0 - F.levenshtein(s, t) / longer)

    return (F.when(a == b, 1.0)
            .when(bx == by, F.greatest(alike(x[1], y[1]), alike(x[2], y[2])))
            .when(bx == 2 * by, alike(x[1], y[2]))
            .when(2 * bx == by, alike(x[2], y[1]))
            .otherwise(0.0))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by as many of ``following``'s first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _with_next(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by span, in it by falling id, with a copy of the next span's first row at the end."""
    held = None  # (doc_id, text, signature)
    for batch in batches:
        out = []
        for span, extra, doc_id, text in zip(batch["span"], batch["extra"], batch["doc_id"], batch["text"], strict=True):
            sign = text_signature(text)
            if held is not None and held[0] == span:
                _, own, own_text, own_sign = held
                new = edited(own_text, text)
                out.append((own, len(own_text), _digest(new), own_sign, text_signature(new), sign))
            held = None if extra else (span, doc_id, text, sign)
        frame = pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        yield frame


def _spans(rows: DataFrame, spans: int) -> DataFrame:
    """Adds span: 0 for the largest ids, upwards for smaller ones, the last for missing ids. The bounds
    are approximate quantiles of the ids: driver data in the number of spans, not of rows."""
    cuts = rows.where("doc_id is not null").stat.approxQuantile(
        "doc_id", [i / spans for i in range(1, spans)], 0.2 / spans) if spans > 1 else []
    splits = [float("-inf"), *sorted({0.0} | {float(int(c)) for c in cuts}), float("inf")]
    placed = Bucketizer(splits=splits, inputCol="place", outputCol="bucket", handleInvalid="keep").transform(
        rows.withColumn("place", F.col("doc_id").cast("double")))
    last = len(splits) - 1
    span = F.when(F.col("doc_id").isNull(), last).otherwise(F.lit(last - 1) - F.col("bucket")).cast("int")
    return placed.withColumn("span", span).drop("place", "bucket")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint of each whole text, of its edit with the next document's, and their likeness.

    Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The next document is that of the next smaller id, the
    last one's is the first; missing texts are empty, missing ids come last, equal ids in order of
    their text's digest. A single row is its own next. Repeated rows stay.

    The texts are moved once, to spans of neighbouring ids; each span also gets a copy of the first
    row of the next one, found beforehand from ids and digests alone, so no order over all is needed.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = ["nulls", "falling", "digest"]
    keyed = (_spans(rows, 4 * partitions).withColumn("nulls", F.col("doc_id").isNull())
             .withColumn("falling", -F.col("doc_id")).withColumn("digest", F.md5("text")))
    firsts = keyed.groupBy("span").agg(F.min(F.struct("nulls", "falling", "digest")).alias("k"))
    before = F.coalesce(F.lag("span").over(Window.orderBy("span")), F.max("span").over(Window.partitionBy()))
    firsts = written(firsts.select(F.col("span").alias("from"), before.alias("to"), "k.*"), "firsts")
    same = F.col("from") == F.col("span")
    for c in order:
        same = same & firsts[c].eqNullSafe(keyed[c])
    copies = (keyed.join(firsts, same).groupBy(F.col("to").alias("span"))
              .agg(F.first(keyed["doc_id"]).alias("doc_id"), F.first("text").alias("text")))
    body = keyed.select("span", F.lit(False).alias("extra"), "doc_id", "text", "nulls", "falling", "digest")
    tail = copies.select("span", F.lit(True).alias("extra"), "doc_id", "text", F.lit(True).alias("nulls"),
                         F.lit(None).cast("long").alias("falling"), F.lit("").alias("digest"))
    dealt = (body.unionByName(tail).repartition(partitions, "span")
             .sortWithinPartitions("span", "extra", *order).select("span", "extra", "doc_id", "text"))
    done = dealt.mapInPandas(_with_next, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, next_fingerprint string")
    return done.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))

"""SimHash near-duplicates: fingerprints, links by Hamming distance, components.

Links are found with a pivot distance table: the distance of each distinct fingerprint to fourteen
reference fingerprints is computed once. By the triangle inequality two fingerprints within
``LIMIT`` bits differ by at most ``LIMIT`` in every coordinate, so pairs with a larger coordinate
difference are discarded unseen, and the survivors are verified by their own distance.

Which pairs meet at all: six blocks of bits, of which four differing bits leave two untouched, so
linked fingerprints agree in one of the fifteen pairs of blocks. That is exact at any size; for far
more than 10**9 distinct fingerprints, more blocks (``blocks=8``: 70 keys of 32 bits) keep the
buckets small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.llm.common import bucket_components, shared_buckets, written

SHINGLE, LIMIT, SEED, BLOCKS = 4, 4, 42, 6
#: Reference fingerprints: 64-bit words from the generator of Steele et al. (SplitMix64).
PIVOTS = 14
#: Distances packed in one long, a byte each; the sign's byte stays free.
LANES = 7


def pivots(count: int = PIVOTS) -> list[int]:
    mask, state, out = (1 << 64) - 1, 0, []
    for _ in range(count):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(z ^ (z >> 31))
    return [p - (1 << 64) if p >> 63 else p for p in out]


def text_fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the word shingles: a bit is 1 if set in over half their hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII case and blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    width = min(SHINGLE, len(words))
    digest = xxhash.xxh64_digest
    spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1:] - 1).tolist(), strict=True)
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):  # bounded memory for the longest texts
        ones += np.unpackbits(hashes[at:at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([text_fingerprint(t) for t in batch], dtype="int64")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _lanes(byte: int) -> Column:
    return F.lit(sum(byte << (8 * i) for i in range(LANES)))


def pivot_table(fp: Column) -> list[Column]:
    """The distances to the pivots, ``LANES`` to a long."""
    refs = pivots()
    columns = []
    for part in range(0, PIVOTS, LANES):
        packed = F.lit(0).cast("long")
        for i, p in enumerate(refs[part:part + LANES]):
            packed = packed + F.shiftleft(distance(fp, F.lit(p)).cast("long"), 8 * i)
        columns.append(packed.alias(f"t{part // LANES}"))
    return columns


def coordinates_near(a: Column, b: Column) -> Column:
    """No coordinate of two packed rows of the table differs by more than ``LIMIT``.

    All lanes at once: 128 + a - b + LIMIT lies between 128 and 128 + 2 LIMIT in each byte, without a
    carry into the next one, as distances are 64 at most.
    """
    moved = a.bitwiseOR(_lanes(128)) - b + _lanes(LIMIT)
    over = (moved.bitwiseAND(_lanes(127)) + _lanes(127 - 2 * LIMIT)).bitwiseAND(_lanes(128))
    return (moved.bitwiseAND(_lanes(128)) == _lanes(128)) & (over == 0)


def fingerprint_buckets(fps: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(bucket, id): each fingerprint under every choice of the blocks that must agree."""
    bounds = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for number, kept in enumerate(combinations(range(blocks), blocks - LIMIT)):
        mask = sum(((1 << (bounds[k + 1] - bounds[k])) - 1) << bounds[k] for k in kept)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask))))
    return fps.select(F.explode(F.array(*keys)).alias("bucket"), F.col("fp").alias("id"))


def near(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Within ``LIMIT`` bits: the coordinates first, then the fingerprints themselves."""
    return coordinates_near(a("t0"), b("t0")) & coordinates_near(a("t1"), b("t1")) & (distance(a("id"), b("id")) <= LIMIT)


def fingerprint_components(fps: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(id, component) of the distinct fingerprints ``fps`` (fp: long) that have a link."""
    buckets = shared_buckets(fingerprint_buckets(fps, blocks), lambda rows: rows.select("*", *pivot_table(F.col("id"))))
    return bucket_components(buckets, lambda pairs: pairs, near)


def simhash_components(docs: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id of the rows reachable over links of fingerprints, the
    row's own included, nulls left out (null if all of them are). A missing text is an empty one.
    Without words the fingerprint is zero and links like any other. Repeated rows stay.
    """
    rows = written(docs.select("doc_id", fingerprint(F.coalesce("text", F.lit(""))).alias("fp")), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash")
    linked = fingerprint_components(distinct.select("fp"), blocks)
    named = distinct.join(linked.withColumnRenamed("id", "fp"), "fp", "left").withColumn("c", F.coalesce("component", "fp"))
    named = written(named.select("fp", "c", "least"), "simhash")
    smallest = named.groupBy("c").agg(F.min("least").alias("component_id"))
    at = written(named.join(smallest, "c").select("fp", "component_id"), "simhash")
    return rows.join(at, "fp").select("doc_id", "fp", "component_id")


def simhash_report(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), the fingerprint as 16 lower-case hex digits."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return simhash_components(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (missing ids last), of several with that
    id the one with the smallest text digest, and of several equal in both any one.

    Fingerprints link as in ``simhash_components``; missing texts are empty ones. An empty table gives an
    empty one, further columns are carried along, whatever their names.
    """
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id",
                         F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    rows = written(docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
                               fingerprint(F.coalesce("text", F.lit(""))).alias("fp")), "simhash")
    named = rows.groupBy("fp", "doc_id", "digest").agg(F.count("*").alias("n"))
    linked = fingerprint_components(rows.select("fp").distinct())
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "n")).alias("k")
    kept = (named.join(linked.withColumnRenamed("id", "fp"), "fp", "left").groupBy(F.coalesce("component", "fp").alias("c")).agg(least)
            .select(F.col("k.doc_id").alias("kept_id"), F.col("k.digest").alias("kept_digest"), F.col("k.n").alias("n")))
    kept = written(kept, "simhash")
    found = packed.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")))
    single = found.where("n = 1").select("row.*")
    several = found.where("n > 1").groupBy("doc_id", "digest").agg(F.first("row").alias("row")).select("row.*")
    return single.union(several)

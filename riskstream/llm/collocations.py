"""Phrase collocations by stripes: each prefix keys an associative counter of its next words.

Each task splits its texts into words and counts, per prefix, the words that follow it, the end of a
piece included: a stripe. Stripes of one prefix are merged element by element. One structure answers
everything: an entry is the frequency of prefix and next word, a stripe's sum that of the prefix, its
largest entry the longest extension's share. The empty prefix's stripe holds the single words, the
stripes of two-word prefixes the phrases of two (sums) and three words (entries).

Stripes travel packed by bucket of their prefix, a few rows per task and bucket instead of one per
word. A prefix of two words that are both among the most frequent ones may hold any share of the
text: its stripe is dealt over all buckets by next word, and only its sums are added up again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import written

#: Least frequency, units of a score, per cent of a phrase inside a longer one, phrases per language.
LEAST, UNITS, INSIDE, MOST = 10, 1_000_000, 50, 2000
#: A word is frequent from one in so many occurrences on, so there are at most so many of them.
FREQUENT = 4096
#: Bytes of text that are counted at a time; buckets per shuffle partition.
CHUNK, BUCKETS = 4 << 20, 4
#: Phrases of a language are ranked in so many parts first.
PARTS = 16
#: Upper case, ends of pieces, tab.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """(lang, texts) of at most ``CHUNK`` bytes, or of one longer text, out of batches (lang, text)."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column(1).filter(pc.equal(langs.indices, code))
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
                yield lang, texts.slice(at, upto - at)
                at = upto


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word in order, number of the piece that each stands in)."""
    plain = pa.array([b"\n".join(texts.cast(pa.binary()).to_pylist()).translate(_PLAIN)], pa.binary()).cast(pa.large_binary())
    pieces = pc.split_pattern(plain, b"\n").flatten()
    split = pc.split_pattern(pieces, b" ")
    codes = split.flatten().dictionary_encode()
    numbers = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), np.diff(split.offsets.to_numpy()))
    empty = pc.index(codes.dictionary, pa.scalar(b"", codes.dictionary.type)).as_py()
    kept = numbers != empty
    return codes.dictionary, numbers[kept], piece[kept]


def sorted_runs(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows of ``columns`` (codes below ``size``) together, and where they begin."""
    if size ** len(columns) < 1 << 63:
        key = columns[0].astype(np.int64)
        for c in columns[1:]:
            key = key * size + c
        order = np.argsort(key)
        sorted_key = key[order]
        new = sorted_key[1:] != sorted_key[:-1]
    else:
        order = np.lexsort(columns[::-1])
        new = np.zeros(max(0, len(order) - 1), dtype=bool)
        for c in columns:
            new |= c[order][1:] != c[order][:-1]
    return order, np.flatnonzero(np.concatenate(([True], new))) if len(order) else np.zeros(0, dtype=np.int64)


def summed(columns: list[np.ndarray], n: np.ndarray | None, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``columns`` in order and the sum of ``n`` (or their number) of each."""
    order, starts = sorted_runs(columns, size)
    firsts = order[starts]
    counts = np.diff(np.append(starts, len(order))) if n is None else np.add.reduceat(n[order], starts) if len(starts) else n
    return [c[firsts] for c in columns], counts


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f): the merged stripe of the empty prefix."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in chunks(batches):
            words, codes, _ = words_of(texts)
            n = np.bincount(codes, minlength=len(words))
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), words.take(pa.array(seen)).cast(pa.binary()).cast(pa.string()),
                                              pa.array(n[seen], pa.int64())], ["lang", "word", "f"])

    return docs.mapInArrow(counted, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def stripes_in(lang: str, texts: pa.Array, buckets: int, frequent: set[str]) -> pa.RecordBatch | None:
    """The stripes of all two-word prefixes of ``texts``, a row per bucket."""
    words, codes, piece = words_of(texts)
    if len(codes) < 2:
        return None
    size = len(words) + 1  # the last code is the end of a piece
    third = np.append(np.where(piece[2:] == piece[:-2], codes[2:], size - 1), size - 1)
    inside = piece[1:] == piece[:-1]
    (first, second, follow), n = summed([codes[:-1][inside], codes[1:][inside], third[inside]], None, size)
    if not len(n):
        return None
    listed = words.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w, 1) for w in listed] + [1], dtype=np.uint64)
    often = np.array([w.decode() in frequent for w in listed] + [False]) if frequent else np.zeros(size, dtype=bool)
    mixed = (hashes[first] * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[second]
    dealt = often[first] & often[second]
    mixed = np.where(dealt, (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[follow], mixed)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    bucket = ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    rows = []
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        a, b, c = first[part], second[part], follow[part]
        known, local = np.unique(np.concatenate((a, b, c[c < size - 1])), return_inverse=True)
        a, b, ends = local[:len(a)], local[len(a):2 * len(a)], c == size - 1
        c = np.where(ends, -1, 0)
        c[~ends] = local[2 * len(a):]
        new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        rows.append({"lang": lang, "bucket": int(bucket[part[0]]), "words": b"\n".join([listed[k] for k in known]).decode(),
                     "first": a[new].astype(np.int32), "second": b[new].astype(np.int32), "width": np.diff(np.append(new, len(a))).astype(np.int32),
                     "follow": c.astype(np.int32), "n": n[part].astype(np.int32)})
    return pa.RecordBatch.from_pylist(rows, STRIPES)


_INTS = pa.list_(pa.int32())
STRIPES = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("words", pa.string()), ("first", _INTS),
                     ("second", _INTS), ("width", _INTS), ("follow", _INTS), ("n", _INTS)])
_STRIPES_DDL = ("lang string, bucket int, words string, first array<int>, second array<int>, width array<int>, "
                "follow array<int>, n array<int>")
_MERGED_DDL = "lang string, w1 string, w2 string, w3 string, f long"


def merged_stripes(table: pa.Table, frequent: set[str], least: int) -> pa.Table:
    """The stripes of one bucket and language, merged: a row per entry of ``least`` or more, and, without
    third word, a row per prefix with its sum, of ``least`` or more unless the prefix is dealt over buckets."""
    table = table.combine_chunks()
    column = {name: table.column(name).chunk(0) for name in STRIPES.names}
    split = pc.split_pattern(column["words"], "\n")
    codes = split.flatten().dictionary_encode()
    words, codes = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = len(words) + 1
    at = split.offsets.to_numpy()[:-1].astype(np.int64)

    def flat(name: str) -> np.ndarray:
        return column[name].flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def row_of(name: str) -> np.ndarray:
        return np.repeat(at, np.diff(column[name].offsets.to_numpy()))

    prefix_at, width, follow = row_of("first"), flat("width"), flat("follow")
    first, second = (np.repeat(codes[prefix_at + flat(c)], width) for c in ("first", "second"))
    follow = np.where(follow < 0, size - 1, codes[np.where(follow < 0, 0, row_of("follow") + follow)])
    (a, b, c), n = summed([first, second, follow], flat("n"), size)
    (head, tail), total = summed([a, b], n, size)
    often = pc.is_in(words, pa.array(sorted(frequent), pa.string())).to_numpy(zero_copy_only=False) if frequent else np.zeros(size, dtype=bool)
    prefix = (total >= least) | (often[head] & often[tail])
    entry = (n >= least) & (c < size - 1)

    def named(code: np.ndarray) -> pa.Array:
        return words.take(pa.array(code))

    count = int(entry.sum()), int(prefix.sum())
    return pa.table([pa.array([column["lang"][0].as_py()] * sum(count), pa.string()),
                     pa.concat_arrays([named(a[entry]), named(head[prefix])]), pa.concat_arrays([named(b[entry]), named(tail[prefix])]),
                     pa.concat_arrays([named(c[entry]), pa.nulls(count[1], pa.string())]),
                     pa.array(np.concatenate((n[entry], total[prefix])), pa.int64())], ["lang", "w1", "w2", "w3", "f"])


def phrase_counts(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """(lang, w1, w2, w3, f): phrases of two words (w3 null) and of three that occur ``least`` times or more.
    ``words`` is the written result of ``word_counts``."""
    total = words.agg(F.sum("f")).first()[0] or 0
    often: dict[str, set[str]] = {}
    for row in words.where(F.col("f") * FREQUENT >= total).select("lang", "word").collect():  # FREQUENT rows at most
        often.setdefault(row.lang, set()).add(row.word)
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in chunks(batches):
            found = stripes_in(lang, texts, buckets, often.get(lang, set()))
            if found is not None:
                yield found

    def merge(table: pa.Table) -> pa.Table:
        return merged_stripes(table, often.get(table.column("lang")[0].as_py(), set()), least)

    parts = docs.mapInArrow(stripes, _STRIPES_DDL).groupBy("lang", "bucket").applyInArrow(merge, _MERGED_DDL)
    parts = written(parts, "stripes")
    pairs = parts.where("w3 is null").groupBy("lang", "w1", "w2").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return pairs.select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "f").union(parts.where("w3 is not null"))


def cut_score(a: str, left: str, right: str) -> Column:
    """floor(``UNITS`` a a / (l r)) of the columns named, exact while no product has more than 38 digits."""
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"({wide(a)} * {wide(a)} * {UNITS}BD) div ({wide(left)} * {wide(right)})")


def scored_phrases(phrases: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases that no longer one subsumes. ``phrases`` and ``words``
    are the written results of ``phrase_counts`` and ``word_counts``."""
    pairs = phrases.where("w3 is null").select("lang", "w1", "w2", "f")
    triples = phrases.where("w3 is not null").withColumnRenamed("f", "a")
    common = words.where(F.col("f") >= least)

    def of_word(word: str, name: str) -> DataFrame:
        return common.select("lang", F.col("word").alias(word), F.col("f").alias(name))

    def of_pair(one: str, other: str, name: str) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(one), F.col("w2").alias(other), F.col("f").alias(name))

    parts = F.explode(F.array(F.struct(F.col("w1").alias("w1"), F.col("w2").alias("w2")),
                              F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"))))
    longest = (triples.select("lang", "a", parts.alias("part")).groupBy("lang", "part.w1", "part.w2")
               .agg(F.max("a").alias("longest")))
    two = (pairs.withColumnRenamed("f", "a").join(longest, ["lang", "w1", "w2"], "left")
           .where(F.col("longest").isNull() | (100 * F.col("longest") < INSIDE * F.col("a")))
           .join(of_word("w1", "l"), ["lang", "w1"]).join(of_word("w2", "r"), ["lang", "w2"])
           .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", cut_score("a", "l", "r").alias("score")))
    three = (triples.join(of_pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(of_pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
             .join(of_word("w1", "l1"), ["lang", "w1"]).join(of_word("w3", "r2"), ["lang", "w3"])
             .withColumns({"s1": cut_score("a", "l1", "r1"), "s2": cut_score("a", "l2", "r2")}))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                         F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    return two.union(three)


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of two and three words per language.

    Of ``docs`` only text and lang are read: missing texts are empty, a missing language is ``und`` (and
    one with a language of that name), repeated rows count each time, equal scores go by frequency, then
    by the phrase's bytes. Whole texts count, pieces without words and empty tables give nothing.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = written(word_counts(rows), "words")
    phrases = written(phrase_counts(rows, words, least), "phrases")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    ahead = (scored_phrases(phrases, words, least).withColumn("part", part)
             .withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= most))
    best = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

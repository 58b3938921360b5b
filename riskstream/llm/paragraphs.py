"""Substring dedup: repeated and nearly repeated paragraphs by MinHash banding, and repeated passages.

A paragraph is a line of at least ``LEAST_WORDS`` words, or a run of shorter lines with as many words
together, up to an empty or a long line, so that text wrapped at any narrow width is one paragraph with
the same words as in one line. Each line belongs to one paragraph at most. Equal ones (case and blanks aside) are one
paragraph from the start. MinHash signatures over word shingles are banded so that a pair at the
threshold meets with the wanted recall; colliding paragraphs are verified by exact Jaccard
similarity, linked ones form components, and of a component's occurrences the first stays.

Passages need no line ends: any ``PASSAGE`` words in a row that stand in an earlier document go too.
Of each ``PASSAGE`` words the shingle of ``ANCHOR`` words with the least hash is kept (the MinHash of
that stretch), so documents with such a passage in common share a kept shingle wherever it stands in
them. Only around shared ones all stretches of ``PASSAGE`` words are hashed and compared, and what is cut
is their union: the whole common passage.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.llm.common import bucket_components, bucketed, result_only, shared_buckets, stored, written
from riskstream.session import remove_folder

SHINGLE, THRESHOLD, LEAST_WORDS = 5, 0.8, 20
#: Words of a passage, and of the shingles that find it.
PASSAGE, ANCHOR = 50, 20
#: Pairs at the threshold that must collide; pairs at half of it that may.
RECALL, FALSE = 0.995, 0.5
#: Longs of a paragraph's bit sketch.
SKETCH = 16
#: Code points of the texts whose words are hashed at a time.
CHARS = 1_000_000
#: Hashes of passages that are sent on at once.
STRETCHES = 200_000
_BLANK = " \t\n\x0b\f\r"
_WORD = re.compile(f"[^{_BLANK}]+")
#: Odd base of the polynomial hashes, and its inverse, modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def tuned_bands(threshold: float = THRESHOLD, recall: float = RECALL, false: float = FALSE) -> tuple[int, int]:
    """(bands, rows) with the fewest hash functions that keep the recall at ``threshold`` and collide
    with at most ``false`` of the pairs at half of it."""
    fits = [(bands * rows, bands, rows) for rows in range(1, 9) for bands in range(1, 129)
            if 1 - (1 - threshold ** rows) ** bands >= recall and 1 - (1 - (threshold / 2) ** rows) ** bands <= false]
    _, bands, rows = min(fits)
    return bands, rows


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, the 64-bit hashes of all words in a row, the words of each text with one blank between
    them). The texts are split together, and each word is hashed once."""
    trimmed = pc.ascii_trim_whitespace(pa.array(texts, pa.large_string()))
    split = pc.ascii_split_whitespace(pc.if_else(pc.equal(trimmed, ""), pa.scalar(None, pa.large_string()), trimmed))
    words = split.flatten().dictionary_encode()
    known = words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, known), dtype=np.uint64, count=len(known))
    counts = pc.fill_null(split.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = pc.binary_join(split, pa.scalar(" ", pa.large_string())).to_numpy(zero_copy_only=False)
    return counts, known[words.indices.to_numpy(zero_copy_only=False)], joined


def lower_parts(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in lower case, some at a time."""
    part, size = [], 0
    for text in texts:
        part.append(text.lower())
        size += len(text)
        if size >= CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def text_hashes(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The hashes of the words of each text, in any case."""
    for part in lower_parts(texts):
        counts, hashes, _ = hashed(part)
        yield from np.split(hashes, np.cumsum(counts)[:-1])


class WordHashes:
    """The hashes of the words of one text."""

    def of(self, text: str) -> np.ndarray:
        return next(text_hashes([text]))


def _shingles(hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the word shingles, one of all words if they are few."""
    width = min(SHINGLE, len(hashes))
    mixed = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for at in range(width):
        mixed = (mixed ^ hashes[at:at + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def band_hashes(parts: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """The band hashes of each paragraph out of its shingles' hashes."""
    flat = np.concatenate(parts)
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))
    seeds = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, size=(bands * rows, 2), dtype=np.uint64) | np.uint64(1)
    out = np.zeros((len(parts), bands), dtype=np.uint64)
    for n, (factor, plus) in enumerate(seeds):
        turned = flat * factor + plus
        turned ^= turned >> np.uint64(32)
        least = np.minimum.reduceat(turned * np.uint64(0xD6E8FEB86659FD93), starts)
        band = n // rows
        out[:, band] = (out[:, band] ^ least) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band + 1)
    return out.view(np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The number of distinct shingles, and ``SKETCH`` longs with a bit for each shingle's hash."""
    for batch in texts:
        out = []
        for hashes in text_hashes(batch):
            found = np.unique(_shingles(hashes))
            bits = np.zeros(64 * SKETCH, dtype=np.uint8)
            bits[found % np.uint64(64 * SKETCH)] = 1
            out.append([len(found), *np.packbits(bits).view(np.int64).tolist()])
        yield pd.Series(out, index=batch.index)


def may_be_near(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """False only for pairs below the threshold: a bit that one sketch alone has stands for at least one
    shingle that the other text lacks, which bounds the shingles in common."""
    def common(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        alone = sum((F.bit_count(x(f"s{i}").bitwiseAND(F.bitwise_not(y(f"s{i}")))) for i in range(1, SKETCH + 1)), F.lit(0))
        return x("s0") - alone

    needed = THRESHOLD / (1 + THRESHOLD) * (a("s0") + b("s0")) - 1e-6
    return F.least(common(a, b), common(b, a)) >= needed


@F.pandas_udf(T.DoubleType())
def jaccard(left: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    def sets(text: str) -> set:
        words = text.split(" ")
        width = min(SHINGLE, len(words))
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}

    for a, b in left:
        known = {t: sets(t) for t in {*a, *b}}  # a text has many partners in a group of near copies
        common = [len(known[x] & known[y]) for x, y in zip(a, b, strict=True)]
        sizes = [len(known[x]) + len(known[y]) for x, y in zip(a, b, strict=True)]
        yield pd.Series([c / (n - c) for c, n in zip(common, sizes, strict=True)], dtype="float64")


def normalised(line: Column) -> Column:
    """A paragraph's words, lower-cased, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(line), "[\\x20\\x09-\\x0D]+", " "))


def spans(counts: Iterable[int]) -> Iterator[tuple[int, int, int, int]]:
    """(first line, line after the last, number of the first word, words) of each paragraph of a text, of which
    ``counts`` are the words of its lines."""
    first = start = size = at = line = 0
    for line, count in enumerate(counts):
        if 0 < count < LEAST_WORDS:
            if not size:
                first, start = line, at
            size += count
            at += count
            continue
        if size >= LEAST_WORDS:
            yield first, line, start, size
        size = 0
        if count:
            yield line, line + 1, at, count
        at += count
    if size >= LEAST_WORDS:
        yield first, line + 1, start, size


def units(text: str) -> Iterator[tuple[int, int, str]]:
    """(number of the first word, words, the words themselves) of each paragraph of ``text``."""
    lines = [line.split() for line in text.lower().encode("utf-8", "surrogatepass").split(b"\n")]
    for first, last, at, size in spans(map(len, lines)):
        yield at, size, b" ".join(chain.from_iterable(lines[first:last])).decode("utf-8", "surrogatepass")


def document_rows(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """One look at each text for both searches: (doc_id, slot, key, pos, size, pid, bands) of its paragraphs, their words
    and band hashes, and one more row with its (anchors), the hashes of the kept shingles, if any. ``slot`` and ``key``
    name the document."""
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*docs.select("doc_id", "slot", "key").schema.fields, T.StructField("pos", T.IntegerType()),
                           T.StructField("size", T.IntegerType()), T.StructField("pid", T.LongType()),
                           T.StructField("bands", longs), T.StructField("anchors", longs)])

    def packed(batch: pa.RecordBatch, index: list[int], *columns: pa.Array) -> pa.RecordBatch:
        named = [batch.column(c).take(pa.array(index, pa.int32())) for c in ("doc_id", "slot", "key")]
        return pa.RecordBatch.from_arrays([*named, *columns], schema.names)

    def paragraphs_in(batch: pa.RecordBatch, found: list[tuple[int, int, int, str]], shingles: list[np.ndarray]) -> pa.RecordBatch:
        index, pos, sizes, words = zip(*found, strict=True)
        pids = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64).view(np.int64)
        hashes = [*band_hashes(shingles, bands, rows)]
        return packed(batch, index, pa.array(pos, pa.int32()), pa.array(sizes, pa.int32()), pa.array(pids), _listed(hashes),
                      pa.nulls(len(index), pa.list_(pa.int64())))

    def anchors_in(batch: pa.RecordBatch, index: list[int], kept: list[np.ndarray]) -> pa.RecordBatch:
        nothing = [pa.nulls(len(index), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
        return packed(batch, index, *nothing, _listed(kept))

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in lower_parts(text.as_py() or "" for text in batch.column("text")):
                lines = [text.split("\n") for text in part]
                counts, hashes, words = hashed([*chain.from_iterable(lines)])
                mixed = _shingles(hashes) if len(hashes) else hashes
                counts, line, word = counts.tolist(), 0, 0
                found, shingles, marked, kept = [], [], [], []
                for n, own in enumerate(lines, at):
                    sizes = counts[line:line + len(own)]
                    for first, last, pos, size in spans(sizes):
                        found.append((n, pos, size, " ".join(words[line + first:line + last])))
                        shingles.append(mixed[word + pos:word + pos + size - SHINGLE + 1])
                    total = sum(sizes)
                    marks = np.unique(anchors(hashes[word:word + total])[1])
                    if len(marks):
                        marked.append(n)
                        kept.append(marks)
                    line += len(own)
                    word += total
                if found:
                    yield paragraphs_in(batch, found, shingles)
                if marked:
                    yield anchors_in(batch, marked, kept)
                at += len(part)

    return docs.select("doc_id", "slot", "key", "text").mapInArrow(found_in, schema)


def in_documents(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Bucketed ``docs`` joined with ``rows`` (slot_, key_, ...), without moving the documents.

    Only the bucket column may be an equality for that, so the second hash is compared as a range.
    """
    return docs.join(rows, (docs["slot"] == rows["slot_"]) & docs["key"].between(rows["key_"], rows["key_"]), how)


def texts_of(docs: DataFrame, places: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pid, words) of the paragraphs ``wanted`` (pid), each read at one of its places."""
    at = (places.select("pid", "slot", "key", "pos").join(wanted, "pid", "left_semi")
          .groupBy("pid").agg(F.min(F.struct("slot", "key", "pos")).alias("at")))
    at = at.groupBy(F.col("at.slot").alias("slot_"), F.col("at.key").alias("key_")).agg(
        F.map_from_entries(F.collect_set(F.struct("at.pos", "pid"))).alias("found"))
    texts = in_documents(docs.select("slot", "key", "text"), at, "inner").dropDuplicates(["slot", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, found in zip(batch.column("text"), batch.column("found"), strict=True):
                pids = dict(found.as_py())
                rows = [(pids[pos], words) for pos, _, words in units(text.as_py()) if pos in pids]
                if rows:
                    ids, words = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.string())], ["pid", "words"])

    return texts.select("text", "found").mapInArrow(read, "pid long, words string")


def first_copies(docs: DataFrame) -> DataFrame:
    """(slot, key, whole) of each document of ``docs``: ``whole`` if an earlier one has the same text."""
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "slot")
    names = written(docs.select("doc_id", "slot", "key").distinct(), "places")
    first = names.groupBy("key").agg(F.min(place).alias("first"))
    return written(names.join(first, "key").select("slot", "key", (place != F.col("first")).alias("whole")), "copies")


def repeated_paragraphs(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(slot_, key_, paragraphs): for each document that loses paragraphs, the (pos, size) they have.
    ``docs`` (doc_id, text, slot, key) is bucketed by slot; ``rows`` are the ``document_rows`` of those looked at."""
    places = rows.where("pid is not null").drop("anchors")
    buckets = shared_buckets(places.select(F.explode("bands").alias("bucket"), F.col("pid").alias("id")))
    wanted = buckets.select(F.col("id").alias("pid")).distinct()
    texts = written(texts_of(docs, places, wanted), "texts")

    def verify(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(F.col("pid").alias(c), F.col("words").alias(f"{c}_words")) for c in ("a", "b"))
        return pairs.join(a, "a").join(b, "b").where(jaccard("a_words", "b_words") >= THRESHOLD).select("a", "b")

    sketches = texts.select(F.col("pid").alias("id"), sketch("words").alias("s"))
    sketches = sketches.select("id", *[F.col("s")[i].alias(f"s{i}") for i in range(SKETCH + 1)])
    described = written(buckets.join(sketches, "id"), "buckets")
    linked = written(bucket_components(described, verify, may_be_near).withColumnRenamed("id", "pid"), "linked")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key", "pos")
    named = (places.select("doc_id", "slot", "key", "pos", "size", "pid").join(linked, "pid", "left")
             .select("doc_id", "slot", "key", "pos", "size", F.coalesce("component", "pid").alias("c")))
    groups = named.groupBy("c").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    groups = written(groups.select("c", "first"), "groups")
    later = named.join(groups, "c").where(place != F.col("first"))
    return (later.groupBy(F.col("slot").alias("slot_"), F.col("key").alias("key_"))
            .agg(F.collect_list(F.struct("pos", "size")).alias("paragraphs")))


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2**64, at least ``count`` of them; remembered, and doubled when they run out."""
    known = _KNOWN_POWERS.get(base)
    if known is None or len(known) < count:
        known = np.full(max(1 << 12, 2 * count), base, dtype=np.uint64)
        known[0] = 1
        known = _KNOWN_POWERS[base] = np.cumprod(known, dtype=np.uint64)
    return known


_KNOWN_POWERS: dict[int, np.ndarray] = {}


def stretch_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words in a row: polynomials out of running sums, modulo 2**64."""
    count = len(hashes)
    if count < width:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(count + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(_BASE, count)[:count], dtype=np.uint64, out=sums[1:])
    mixed = (sums[width:] - sums[:-width]) * _powers(_INVERSE, count)[:count - width + 1]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def window_best(values: np.ndarray, width: int, better: np.ufunc) -> np.ndarray:
    """``better`` (minimum or maximum) of each ``width`` neighbours, by windows of doubled width."""
    size, found = 1, values
    while 2 * size <= width:
        found = better(found[:-size], found[size:])
        size *= 2
    return found if size == width else better(found[:len(found) - (width - size)], found[width - size:])


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the shingles with the least hash of some ``PASSAGE`` words in a row."""
    found = stretch_hashes(hashes, ANCHOR)
    width = PASSAGE - ANCHOR + 1
    if len(found) < width:
        return np.zeros(0, dtype=np.int64), found[:0]
    padded = np.zeros(len(found) + width - 1, dtype=np.uint64)
    padded[width - 1:len(found)] = window_best(found, width, np.minimum)
    at = np.flatnonzero(window_best(padded, width, np.maximum) == found)
    return at, found[at]


def _listed(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists).view(np.int64)))


def repeated_passages(docs: DataFrame, own: DataFrame, rows: DataFrame) -> DataFrame:
    """(slot_, key_, passages): for each document with passages of earlier documents, their hashes. Looked at are the
    documents ``own`` (slot_, key_); other arguments as for ``repeated_paragraphs``."""
    rows = rows.where("pid is null").select("slot", F.explode("anchors").alias("anchor"))
    shared = written(rows.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "shared")
    around = rows.join(shared, "anchor").groupBy("slot").agg(F.collect_list("anchor").alias("anchors"))
    texts = in_documents(docs, own.join(around, F.col("slot_") == F.col("slot")).drop("slot"), "inner").dropDuplicates(["slot", "key"])

    def near_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("anchors")
            rows, lists, size = [], [], 0
            for at, hashes in enumerate(text_hashes(text.as_py() for text in batch.column("text"))):
                places, found = anchors(hashes)
                places = places[np.isin(found, marks[at].values.to_numpy().view(np.uint64))]
                stretches = stretch_hashes(hashes, PASSAGE)
                found = np.unique(stretches[covered(places - (PASSAGE - ANCHOR), PASSAGE - ANCHOR + 1, len(stretches))])
                if len(found):
                    rows.append(at)
                    lists.append(found)
                    size += len(found)
                if rows and (size >= STRETCHES or at == len(batch) - 1):
                    named = [batch.column(c).take(pa.array(rows, pa.int32())) for c in ("doc_id", "slot")]
                    yield pa.RecordBatch.from_arrays([*named, _listed(lists)], ["doc_id", "slot", "passages"])
                    rows, lists, size = [], [], 0

    columns = "doc_id {}, slot long, passages array<long>".format(docs.schema["doc_id"].dataType.simpleString())
    passages = written(texts.select("doc_id", "slot", "text", "anchors").mapInArrow(near_shared, columns), "passages")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "slot").alias("place")
    rows = passages.select(place, F.explode("passages").alias("passage"))
    repeated = (rows.groupBy("passage").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                .where("first <> last").select("passage", "first"))
    later = (rows.join(written(repeated, "repeated"), "passage").where(F.col("place") != F.col("first"))
             .groupBy("place.slot").agg(F.collect_list("passage").alias("passages")))
    return own.join(later, F.col("slot_") == F.col("slot")).select("slot_", "key_", "passages")


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans of ``width`` that begin at ``starts``."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, np.clip(starts, 0, size), 1)
    np.add.at(steps, np.clip(starts + width, 0, size), -1)
    return np.cumsum(steps[:-1]) > 0


def without_words(text: str, gone: np.ndarray) -> str:
    """``text`` without the words marked in ``gone``, each with the blanks up to the next word."""
    if gone.all():
        return ""
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])))).reshape(-1, 2)
    return "".join([text[starts[a] if a else 0:starts[b]] for a, b in edges.tolist()])


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType())]))
def cut(rows: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    for texts, paragraphs, whole, passages in rows:
        out = []
        each = text_hashes([text for text, hashes in zip(texts, passages, strict=True) if hashes is not None])
        for text, spans, copy, hashes in zip(texts, paragraphs, whole, passages, strict=True):
            if text is None or (spans is None and hashes is None and not copy):
                out.append((text, 0))
                continue
            gone = np.zeros(len(text.encode("utf-8", "surrogatepass").split()), dtype=bool)
            if copy:
                gone |= len(gone) >= PASSAGE
                spans = [{"pos": pos, "size": size} for pos, size, _ in units(text)] if len(gone) < PASSAGE else []
            for span in spans if spans is not None else ():
                gone[span["pos"]:span["pos"] + span["size"]] = True
            if hashes is not None:
                at = np.flatnonzero(np.isin(stretch_hashes(next(each), PASSAGE), np.asarray(hashes, dtype=np.int64).view(np.uint64)))
                gone |= covered(at, PASSAGE, len(gone))
            out.append((without_words(text, gone) if gone.any() else text, int(gone.sum())))
        yield pd.DataFrame(out, columns=["text", "n"], index=texts.index)


def drop_repeated_paragraphs(docs: DataFrame, counted: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with every later occurrence of a paragraph cut from ``text``, and every
    passage of ``PASSAGE`` words or more that stands word for word in an earlier document.

    First is the smallest doc_id (missing ids last), then the smallest text hash, then the place in the
    text. Within one document only paragraphs count. A cut goes from a word to the next word that stays.
    Every row stays, one that loses all its words with an empty text; a missing text stays missing. Rows
    equal in id and text are one document and get equal results. ``counted`` names a column to add:
    the number of words cut. Further columns are carried along, whatever their names.
    """
    short = F.coalesce(F.length("text") < 2 * LEAST_WORDS - 1, F.lit(True))  # no room for a paragraph
    packed = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    named = docs.where(~short).select(packed, F.xxhash64("doc_id", "text").alias("slot"), F.xxhash64("text").alias("key"))
    kept = bucketed(named, "slot", "documents")
    plain = kept.select("row.doc_id", "row.text", "slot", "key")
    named = first_copies(plain).withColumnsRenamed({"slot": "slot_", "key": "key_"})
    own = named.where(~F.col("whole")).select("slot_", "key_")
    texts = in_documents(plain, own, "left_semi").dropDuplicates(["slot", "key"])
    rows, looked = stored(document_rows(texts, *tuned_bands()), "paragraphs")
    gone = (result_only(lambda: repeated_paragraphs(plain, rows), "gone")
            .unionByName(result_only(lambda: repeated_passages(plain, own, rows), "gone"), allowMissingColumns=True)
            .unionByName(named.where("whole"), allowMissingColumns=True).groupBy("slot_", "key_")
            .agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("paragraphs", "whole", "passages")]))
    removed = written(gone, "removed")
    remove_folder(docs.sparkSession, looked)
    found = in_documents(kept, removed, "left")
    changed = F.col("slot_").isNotNull()
    found = found.withColumn("cut", cut(F.when(changed, F.col("row.text")), "paragraphs", "whole", "passages"))
    text = F.when(changed, F.col("cut.text")).otherwise(F.col("row.text")).alias("text")
    columns = [text if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    as_is = [docs[c] for c in docs.columns]
    if counted:
        columns.append(F.col("cut.n").alias(counted))
        as_is.append(F.lit(0).cast("long").alias(counted))
    return found.select(*columns).union(docs.where(short).select(*as_is))

"""The training-data operators against brute force, round trips, held-out labels and odd input."""

from __future__ import annotations

import hashlib
import re
import sys
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import public_tokenizers  # noqa: E402

import corpus_pipeline  # noqa: E402
from riskstream.llm import (bpe, common, fuzzy_hash, labelled, licenses, mixing, paragraphs, quality, queries,  # noqa: E402
                            simhash, topk, toxicity, url_filter)
from tests.compare import differences, duck  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG_TEXT = "word " * 3000 + "x" * 70_000

#: doc_id, text, lang, source, n_chars and two columns whose names helpers might want.
ODD = [
    (1, "one two three four five six", "en", "a", 27, 5, "h"), (2, "", "en", "a", 0, None, None), (3, None, None, None, None, 1, "x"),
    (4, " \t\n ", "en", "b", 4, 1, "x"), (5, LONG_TEXT, "en", "b", len(LONG_TEXT), 1, "x"), (6, "one two three four five six", "en", "c", 27, 1, "x"),
    (6, "one two three four five six", "en", "c", 27, 1, "x"), (None, "no id here", "en", "c", 10, 1, "x"), (None, None, None, None, None, None, None),
    (7, "é \U0001f600 don't <|endoftext|> we'll", "fr", "d", 30, 1, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def components(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, small, name):
    assert not differences(queries.QUERIES[name](spark, small), duck(small), queries.oracle_sql()[name])


def test_url_rules(spark):
    urls = ["http://a.b.com/x/y?q", "HTTP://B.COM/x", "http://b.com", "no scheme", None, "", "http:///p", "http://" + "a." * 3000 + "com/x/" + "y" * 9000,
            "http://xb.com/x/y"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    rules = spark.createDataFrame([("com", "/", "allow"), ("b.com", "/x", "block"), ("a.b.com", "/x/y", "allow"), ("b.com", "/x", "allow"),
                                   (None, "/", "block"), ("b.com", "/x/y", "block")], "host string, path string, action string")
    got = url_filter.judge_urls(spark, pages, rules).collect()
    assert len(got) == 2 * len(urls)
    by = {r.page_id: (r.rule, r.verdict) for r in got}
    assert by[0] == ("a.b.com/x/y", "allow") and by[1] == ("b.com/x", "block") and by[2] == (None, "allow")
    assert [by[i] for i in (3, 4, 5, 6)] == [(None, "allow")] * 4
    assert by[7] == ("com/", "allow") and by[8] == ("com/", "allow")
    assert url_filter.judge_urls(spark, pages.limit(0), rules).count() == 0
    assert url_filter.judge_urls(spark, pages, rules.limit(0), "block").where("verdict = 'block' and rule is null").count() == 2 * len(urls)


def brute_fingerprint(text: str | None) -> int:
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, small):
    rows = common.table(spark, small, "documents").collect()
    got = {r.doc_id: r for r in queries.op3_simhash(spark, small).collect()}
    fps = [brute_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    roots = components(len(rows), links)
    for i, r in enumerate(rows):
        assert got[r.doc_id].fingerprint == f"{fps[i]:016x}"
        assert got[r.doc_id].component_id == min(rows[j].doc_id for j in range(len(rows)) if roots[j] == roots[i])


def test_links_of_random_fingerprints(spark):
    import random
    draw = random.Random(3)
    fps = [draw.getrandbits(64) for _ in range(60)]
    for base in fps[:6]:  # chains of near copies, so that many pairs of a bucket are not linked themselves
        for _ in range(60):
            base ^= sum(1 << b for b in draw.sample(range(64), draw.choice((2, 3, 4, 5))))
            fps.append(base)
    fps = sorted(set(fps))
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    roots = components(len(fps), links)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {r.id: r.component for r in simhash.fingerprint_components(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()}
    linked = {i for pair in links for i in pair}
    assert {signed.index(k) for k in got} == linked
    assert len({(roots[i], got[signed[i]]) for i in linked}) == len({roots[i] for i in linked}) == len(set(got.values()))


def test_simhash_odd_rows(spark, odd, empty):
    got = simhash.simhash_report(odd).collect()
    assert len(got) == len(ODD) and {r.component_id for r in got if r.fingerprint == "0" * 16} == {2}
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 7]
    assert simhash.simhash_report(empty).count() == simhash.drop_near_copies(empty).count() == 0


def test_topk_odd_vectors(spark):
    rows = [(0, [1.0, 0.5]), (20, [float("nan"), 1.0]), (40, None), (60, [None, 1.0]), (1, [2.0]), (2, [1.0, 0.5]), (3, [1.0, 0.5]), (None, [9.0, 9.0]),
            (0, [1.0, 0.5]), (5, [float("inf"), 0.0]), (80, [1e12, -1e12]), (6, [])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = topk.top_k(frame.where("vec_id % 20 = 0"), frame, k=3).orderBy("query_id", "rank").collect()
    top = (1 << 63) - 1
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 80, 64 * int(64e12) - 32 * int(64e12)), (0, 2, 1, 8192), (0, 3, 2, 5120), (80, 1, 1, min(top, 128 * int(64e12))),
        (80, 2, 0, 32 * int(64e12)), (80, 3, 0, 32 * int(64e12))]
    assert topk.top_k(frame.limit(0), frame).count() == topk.top_k(frame, frame.limit(0)).count() == 0


def brute_paragraphs(text: str) -> list[tuple[int, int, str]]:
    """(first word, end, words) of lines of 20 or more words, and of runs of shorter ones with as many."""
    out, run, at = [], [], 0
    for line in [*text.split("\n"), ""]:
        words = re.findall(r"[^\x20\x09-\x0d]+", line.lower())
        if 0 < len(words) < 20:
            run += words
        else:
            if len(run) >= 20:
                out.append((at - len(run), at, " ".join(run)))
            run = []
            if words:
                out.append((at, at + len(words), " ".join(words)))
        at += len(words)
    return out


def brute_cuts(rows) -> dict:
    """(doc_id, text) -> (text left, words cut): paragraphs by all pairs, passages by all 50 words in a row."""
    rows = sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    places = [(n, a, b, words) for n, (_, text) in enumerate(rows) for a, b, words in brute_paragraphs(text)]
    texts = sorted({p[3] for p in places})
    sets = [{tuple(t.split(" ")[i:i + 5]) for i in range(max(1, len(t.split(" ")) - 4))} for t in texts]
    links = []
    for i in range(len(texts)):
        for j in range(i):
            if 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])):
                common = len(sets[i] & sets[j])
                if 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                    links.append((i, j))
    root = dict(zip(texts, components(len(texts), links), strict=True))
    words = [re.findall(r"[^\x20\x09-\x0d]+", text.lower()) for _, text in rows]
    gone, seen, first = [set() for _ in rows], set(), {}
    for n, a, b, text in places:
        if root[text] in seen:
            gone[n] |= set(range(a, b))
        seen.add(root[text])
    for n, known in enumerate(words):
        for i in range(len(known) - 49):
            if first.setdefault(tuple(known[i:i + 50]), n) != n:
                gone[n] |= set(range(i, i + 50))
    out = {}
    for (doc_id, text), lost in zip(rows, gone, strict=True):
        left = re.split(r"(?<![^\x20\x09-\x0d])(?=[^\x20\x09-\x0d])", text)
        lead = left.pop(0) if left and not left[0].strip(" \t\n\r\x0b\f") else ""
        out[(doc_id, text)] = (text, 0) if not lost else (("" if 0 in lost else lead) + "".join(w for i, w in enumerate(left) if i not in lost), len(lost))
    return out


def test_paragraphs_by_brute_force(spark, small):
    docs = common.table(spark, small, "documents").select("doc_id", "text").collect()
    want = brute_cuts(docs)
    got = {(r.doc_id, r.text, r.n_removed) for r in queries.op5_paragraphs(spark, small).collect()}
    assert got == {(r.doc_id, *want[(r.doc_id, r.text)]) for r in docs}
    assert sum(n for _, _, n in got) > 1000


def test_passages_by_brute_force(spark):
    """Passages of 45 to 60 words planted anywhere: inside lines, across them, in several documents, at the ends."""
    import random
    draw = random.Random(8)
    passages = [[f"p{n}w{i}" for i in range(draw.choice((45, 49, 50, 51, 60)))] for n in range(12)]
    rows = []
    for i in range(120):
        words = [f"d{i}w{j}" for j in range(draw.randrange(120))]
        for passage in draw.sample(passages, draw.randrange(3)):
            at, cut = draw.randrange(len(words) + 1), draw.choice((0, 0, 0, 3))
            words[at:at] = [w.upper() if draw.random() < 0.05 else w for w in passage[cut:]]
        rows.append((i, "".join(w + draw.choice((" ", " ", " ", " ", " ", " ", "\n", "  \n\n\t")) for w in words)))
    rows += [*rows[:5], (None, rows[8][1] + " end"), (900, None), (901, "w " * 300), (902, "w " * 200)]
    rows += [(500 + i, text) for i, (_, text) in enumerate(rows[:9])]
    want = brute_cuts(rows)
    got = paragraphs.drop_repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"), counted="n").collect()
    expected = [(r[0], *(want[r] if r[1] is not None else (None, 0))) for r in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected)) and sum(r[2] for r in expected) > 1500


@pytest.mark.parametrize("length", [50, 51, 80])
def test_passages_share_an_anchor(length):
    """Wherever a passage stands, documents that have it in common share a kept shingle that lies in it."""
    import random
    draw = random.Random(length)
    hashes = paragraphs.WordHashes()
    for n in range(300):
        passage = " ".join(f"p{n}w{i}" for i in range(length))
        texts = [" ".join(f"{side}{n}w{i}" for i in range(draw.randrange(70))) + " " + passage + " "
                 + " ".join(f"{side}{n}v{i}" for i in range(draw.randrange(70))) for side in "ab"]
        one, other = (paragraphs.anchors(hashes.of(t))[1] for t in texts)
        assert set(one.tolist()) & set(other.tolist())


def test_small_batches(spark):
    """A stage sends few bytes to Python at once, and a session's own setting stays."""
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    rows = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    stage = corpus_pipeline.lean(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "size long"))
    try:
        for own in (None, "1048576"):
            spark.conf.unset(name) if own is None else spark.conf.set(name, own)
            seen.append([r.size for r in stage(spark, rows, "").collect()])
            assert spark.conf.get(name) == (own or str(common.BATCH_BYTES))
    finally:
        spark.conf.unset(name)
    assert max(seen[0]) < 1.1 * common.BATCH_BYTES and max(seen[1]) < 1.2 * 1048576
    assert all(30_000_000 < sum(found) < 31_000_000 for found in seen)


def test_words_are_hashed_once(monkeypatch):
    """Texts are hashed together, each word once, as if one by one."""
    texts = ["", " \n\n", "a\x1cb c \u0391\u03a3 \u03a3\nb\tC\x0bc\x0cd\rc", " Lead " + "w W " * 300, "c", "\u0130 a\u00a0b"]
    calls = []

    class Counted:
        xxh3_64_intdigest = staticmethod(lambda word: calls.append(word) or xxhash.xxh3_64_intdigest(word))

    monkeypatch.setattr(paragraphs, "xxhash", Counted)
    got = [h.tolist() for h in paragraphs.text_hashes(texts)]
    words = [t.lower().encode().split() for t in texts]
    assert got == [[xxhash.xxh3_64_intdigest(w) for w in own] for own in words]
    assert sorted(calls) == sorted({w for own in words for w in own})


def test_paragraphs_odd_rows(spark, odd, empty):
    line = " ".join(f"w{i}" for i in range(60))
    more = spark.createDataFrame([(8, line + "\nown", "en", "a", 1, 1, "x"), (9, line + "\n" + line.replace("w59", "v"), "en", "a", 1, 1, "x")], SCHEMA)
    cut = paragraphs.drop_repeated_paragraphs(odd.union(more))
    assert cut.columns == odd.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[8] == line + "\nown" and texts[9] == "" and texts[3] is None and texts[2] == "" and texts[5] == LONG_TEXT
    assert cut.count() == len(ODD) + 2 and paragraphs.drop_repeated_paragraphs(empty).count() == 0
    bands, rows = paragraphs.tuned_bands()
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.995
    names = ["slot", "key", "row", "cut", "slot_", "key_", "whole", "passages", "paragraphs", "anchors"]
    clashing = odd.select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    got = paragraphs.drop_repeated_paragraphs(clashing, counted="n")
    assert got.columns == [*clashing.columns, "n"] and got.count() == len(ODD)
    assert got.select(*names).distinct().collect() == [tuple(range(len(names)))]


def test_wrapped_paragraphs(spark):
    passage = [f"w{i}" for i in range(60)]

    def wrapped(width: int) -> str:
        return "\n".join(" ".join(passage[i:i + width]) for i in range(0, 60, width))

    *own, tail = [" ".join(f"{c}{i}" for i in range(25)) for c in "abcdefg"]
    rows = [(1, own[0] + "\n" + wrapped(9) + "\n\nend"), (2, own[1] + "\n\n" + wrapped(9) + "\n"), (3, wrapped(13) + "\n" + own[2]),
            (4, own[3] + "\n" + wrapped(60)), (5, "two words\n \n" + wrapped(7).replace("w59", "new").upper() + "\n\nx\ny"),
            (6, wrapped(9)[:40] + "\n\n" + own[4]), (7, None), (8, own[5] + " " + wrapped(8) + " " + tail), (None, wrapped(1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n) for r in paragraphs.drop_repeated_paragraphs(docs, counted="n").collect()}
    assert got == {1: (rows[0][1], 0), 2: (own[1] + "\n\n", 60), 3: (own[2], 60), 4: (own[3] + "\n", 60), 5: ("two words\n \nx\ny", 60),
                   6: (rows[5][1], 0), 7: (None, 0), 8: (own[5] + " " + tail, 60), None: ("", 60)}


def brute_tokens(text: str | None, tokenizer=Tokenizer.from_file(VOCABULARY)) -> tuple:  # noqa: B008
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    back = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_tokens(spark, small, odd, empty):
    for docs in (common.table(spark, small, "documents"), odd):
        got = bpe.token_report(docs, VOCABULARY)
        both = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect())
        assert both == sorted((str(r.doc_id), *brute_tokens(r.text)) for r in docs.select("doc_id", "text").collect())
    assert bpe.token_report(empty, VOCABULARY).count() == 0


def test_tree_joins(monkeypatch):
    import random
    monkeypatch.setattr(bpe, "PIECE", 24)
    codec, library, draw = bpe.codec(VOCABULARY), Tokenizer.from_file(VOCABULARY), random.Random(4)
    parts = ["abc", "the ing", "aaaa", "  \n\n\t ", "'s've'll", "0123", "!?.,;:***", "éèçñ", "日本語", "😀👩‍👩", "<|endoftext|>", "\r\n\x0b \xa0"]
    for _ in range(400):
        letters = "".join(draw.sample(parts, draw.randint(1, 4)))
        text = "".join(draw.choice(letters if draw.random() < 0.8 else parts) for _ in range(draw.randint(1, 300)))
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_mix(spark, odd, empty):
    report = mixing.mix_report(odd).collect()
    assert len(report) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in report)
    assert sorted(map(str, report)) == sorted(map(str, mixing.mix_report(odd.repartition(3)).collect()))
    rows = mixing.mix_documents(odd)
    assert rows.columns == odd.columns
    assert rows.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in report)
    assert mixing.mix_report(empty).count() == mixing.mix_documents(empty).count() == 0


def test_mix_meets_targets(spark):
    docs = spark.range(40_000).selectExpr("id as doc_id", "repeat('a ', cast(1 + id % 7 as int)) as text", "concat('s', least(id % 5, id % 3)) as source")
    for r in mixing.mix_report(docs).join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r.t - r.g) <= 7


def test_fingerprints(spark, odd, empty):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(["abcdefgh", "", "0123456789", LONG_TEXT, "é" * 9])], "doc_id long, text string, span string")
    got = {r.doc_id: r for r in fuzzy_hash.fingerprint_edits(frame).collect()}
    ordered = sorted(got, reverse=True)
    texts = {r.doc_id: r.text for r in frame.collect()}
    for i, doc_id in enumerate(ordered):
        text, following = texts[doc_id], texts[ordered[(i + 1) % len(ordered)]]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        assert got[doc_id].edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and got[doc_id].n_chars == len(text)
        assert got[doc_id].edited_fingerprint == fuzzy_hash.text_signature(new)
        assert 0 <= got[doc_id].near_edited <= 1
    assert fuzzy_hash.fingerprint_edits(odd).count() == len(ODD)
    assert fuzzy_hash.fingerprint_edits(empty).count() == 0 and fuzzy_hash.fingerprint_edits(frame.limit(1)).count() == 1
    for text in ("a" * 50_000, "ab" * 40_000, "line\n" * 20_000):
        assert len(fuzzy_hash.text_signature(text)) < 200


def test_fingerprints_tell_edits_from_others(spark):
    found = queries.op8_fuzzy_hash(spark, "/root/testdata/sf0.01").agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert found[0] > 0.3 > 0.15 > found[1]


@pytest.mark.parametrize(("query", "label"), [("op2_toxicity", "toxic"), ("op9_quality", "quality")])
def test_held_out_labels(spark, query, label):
    folder = "/root/testdata/sf0.1"
    rows = (queries.QUERIES[query](spark, folder).join(common.table(spark, folder, "labels"), "doc_id").where("held_out").select("score", label).collect())
    good, bad = ([r.score for r in rows if r[label] == v] for v in (1, 0))
    assert good and bad and sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad) > 0.97


def test_classifiers_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 1), (5, 0, 0), (6, 1, 0), (None, 1, 1), (7, None, None), (4, 0, 1)], "doc_id long, quality int, toxic int")
    for report in (toxicity.toxicity_report, quality.quality_report):
        for known in (labels, labels.limit(0)):
            got = report(odd, known).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        assert report(empty, labels).count() == 0
    sample = labelled.labelled_sample(odd, labels, "quality", 5, 0)
    assert {r.doc_id for r in sample.collect()} <= {1, 4, 5, 6}
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def test_licenses(spark, odd, empty):
    rows = [(1, "RELEASED under the MIT Licence!"), (2, "Copyright (c) 2020 Someone\nReleased under the MIT License."),
            (3, "prose\nLicensed under CC BY-NC 4.0.\nmore"), (4, "Released under the MIT License of old."), (5, None)]
    frame = spark.createDataFrame(rows * 2, "doc_id long, text string")
    known = licenses.known_digests(spark)
    got = {r.doc_id: (r.license, r.licenses) for r in licenses.scan_licenses(frame, known).collect()}
    assert got == {1: ("MIT", "MIT"), 2: ("MIT", "MIT"), 3: (None, "CC-BY-NC-4.0"), 4: (None, ""), 5: (None, "")}
    assert licenses.scan_licenses(odd, known).count() == len(ODD) and licenses.scan_licenses(empty, known).count() == 0


def test_whole_licenses(spark):
    from importlib.resources import files
    texts = {f.name: f.read_text() for f in files("riskstream.llm").joinpath("license_texts").iterdir()}
    assert {"MIT.txt", "ISC.txt", "BSD-2-Clause.txt", "BSD-3-Clause.txt", "Apache-2.0.txt", "GPL-2.0-only.txt", "GPL-3.0-only.txt", "MPL-2.0.txt"} <= set(texts)
    rows = [(n.removesuffix(".txt").partition("~")[0], "Copyright (c) 2021 Some One\n\n" + t) for n, t in texts.items()]
    rows += [(n, re.sub(r"\bLICENSE\b", "Licence", t.upper()).replace(",", " ;").replace("HTTP:", "HTTPS:")) for n, t in rows]
    rows += [("MIT", "The MIT Licence (MIT)\n\nCopyright © 1999 A. B.\n\n" + " ".join(texts["MIT.txt"].split())),
             ("BSD-3-Clause", "BSD 3-Clause License\nCopyright (c) 2000, A\nAll rights reserved.\n\n" + texts["BSD-3-Clause.txt"].replace("1. ", "* ")
              .replace("2. ", "* ").replace("3. ", "* ")), (None, texts["MIT.txt"].replace("free of charge", "for a fee")), (None, "x " + texts["MPL-2.0.txt"])]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan_licenses(frame, licenses.known_digests(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == [n for n, _ in rows]


def test_pipeline_stages(spark, small, odd, empty):
    columns = common.table(spark, small, "documents").columns
    docs, ids = common.table(spark, small, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, docs, small), name)
        assert out.columns[: len(columns)] == columns
        ids.append({r.doc_id for r in out.select("doc_id").collect()})
        docs = out
    assert ids[0] >= ids[1] and ids[1] == ids[2] and ids[2] >= ids[3] and ids[3] == ids[4]
    assert corpus_pipeline.run(spark, small).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0
        assert stage(spark, odd, small).count() >= 1


def test_pipeline_near_copies_by_brute_force(spark, small, odd):
    words = [f"w{i}" for i in range(400)]
    planted = [(10_000 + k, " ".join(words[:100 + k] + [f"x{k}"] * (k > 0) + words[101 + k:])) for k in range(0, 300, 9)]
    planted += [(20_000, "a b c"), (20_001, " A  b\tc"), (20_002, "a b d"), (20_003, None), (20_004, " "), (None, "a b c"), (20_000, "a b c")]
    docs = common.table(spark, small, "documents").select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    rows = docs.collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    roots = components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    groups = {}
    for r, root in zip(rows, roots, strict=True):
        groups.setdefault(root, []).append((r.doc_id is None, r.doc_id))
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    assert sorted((r.doc_id is None, r.doc_id) for r in stage(spark, docs, small).collect()) == sorted(min(g) for g in groups.values())
    names = ["row", "doc_id_", "digest", "fp", "n", "kept_id", "component"]
    clashing = odd.select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    got = stage(spark, clashing, small)
    assert got.columns == clashing.columns and got.select(*names).distinct().collect() == [tuple(range(len(names)))]


def test_stages_carry_columns_of_any_name(spark, small, odd):
    names = ["tokens", "n_tokens", "tokens_key", "key", "row", "h", "s", "of", "copy", "mix source", "mix hash", "ids_sha256", "toxicity_p"]
    clashing = odd.select("doc_id", "text", "lang", "source", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, clashing, small)
        assert got.columns[:len(clashing.columns)] == clashing.columns, name
        assert len(set(got.columns)) == len(got.columns) == len(clashing.columns) + 3 * (name == "bpe")
        assert got.select(*[f"`{c}`" for c in names]).distinct().collect() in ([tuple(range(len(names)))], []), name


def test_sample_of_any_number_of_labels(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    for rows, of, want in ((12_000, 10_000, 20_000), (5_000, 20_000, 5_000), (12_000, 10 ** 13, 0)):
        assert abs(ids.where(labelled.chosen_by_hash(rows, of)).count() - want) < 300
    assert spark.range(1).select(F.lit(1).alias("doc_id")).where(labelled.chosen_by_hash(2, 2)).count() == 1


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (50, 51), (51, 50), (None, 3)], "a long, b long")
    got = {r.id: r.component for r in common.connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 51: 50}

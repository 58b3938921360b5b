"""Personal data, collocations and resampling against brute force, planted disguises and odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from riskstream.llm import collocations, common, pii, queries, resampling
from tests.llm.test_llm import ODD, SCHEMA

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def fits(kind: int, found: str) -> bool:
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(p) <= 255 for p in found.split("."))
    if kind == 2:
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def brute_identifiers(text: str) -> list[tuple[int, int, int]]:
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if fits(k, m[0]))


def test_identifiers_by_brute_force():
    draw = random.Random(1)
    for _ in range(20_000):
        text = "".join(draw.choice("ab1234567890.@+- ()_%é\n") for _ in range(draw.randrange(60)))
        assert pii.identifiers(text) == brute_identifiers(text), text


def test_pii_of_whole_texts(spark, small):
    got = {r.doc_id: r for r in queries.op11_pii(spark, small).collect()}
    rows = common.table(spark, small, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        want, row = brute_identifiers(r.text or ""), got[r.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for _, k, _ in want) for kind in range(4)]
        assert row.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
        assert {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want} <= set(row.spans.split(",")) | ({""} if not want else set())


DISGUISES = [
    ("email", "bob [at] example [dot] com"), ("email", "bob(at)mail.example.org"), ("email", "john dot smith at example dot co dot uk"),
    ("email", "jane＠exаmple．com"), ("email", "a​b@exa​mple.com"), ("email", "bob&#64;example&period;com"), ("email", "bob @ example.com"),
    ("email", "ana arroba ejemplo punto es"), ("phone", "plus one nine eight eight five five five two four eight five"),
    ("phone", "+٤٩ (٩٨٨) ٥٥٥-٢٤٨٥"), ("ip", "192[.]168[.]0[.]1"), ("ip", "one nine two dot one six eight dot zero dot one"),
    ("ip", "10 dot 0 dot 0 dot 1"), ("card", "４１１１１１１１１１１１１１１１"), ("card", "four one one one 1111 1111 1111"), ("card", "4111 11l1 1111 1111"),
    ("card", "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins"),
]


@pytest.mark.parametrize(("kind", "disguise"), DISGUISES)
@pytest.mark.parametrize(("before", "after"), [("", ""), ("Ärger, é: ", ", said 𝔸 so"), ("«", "»\nnext line")])
def test_disguises_map_back(kind, disguise, before, after):
    base, every = pii.personal_data(before + disguise + after)
    assert (len(before), pii.KINDS.index(kind), len(before) + len(disguise)) in every
    assert set(base) <= set(every)


@pytest.mark.parametrize("text", ["meet me at example.com today", "look at this point we know", "почта@mail.ru", "one two three four five",
                                  "the dot at the end", "at point one two", "f(x) [1] {2} <b>", "", " ", "12 at 5 dot 3", "ünï"])
def test_clean_texts_get_no_spans(text):
    base, every = pii.personal_data(text)
    assert every == base


@pytest.mark.parametrize("unit", ["x", "1 ", "a@", "one ", "(", " ", "a dot ", "1.", "аа", "a at ", "+1", "a.a@a dot "])
def test_long_texts_take_linear_time(unit):
    pii.personal_data(unit * (200_000 // len(unit)))


def test_pii_odd_rows(spark):
    odd, empty = spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame([], SCHEMA)
    assert pii.find_personal_data(odd).count() == len(ODD) and pii.find_personal_data(empty).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    assert {(r.base_sha256, r.spans) for r in pii.find_personal_data(odd).collect()} == {(none, "")}
    planted = spark.createDataFrame([(1, "mail bob(at)example.com or 10.0.0.1", "x"), (2, None, "y")], "doc_id long, text string, found string")
    assert [r.text for r in pii.mask_personal_data(planted).orderBy("doc_id").collect()] == ["mail [email] or [ip]", None]
    assert pii.find_personal_data(planted).columns[:3] == ["doc_id", "n_email", "n_ip"]


def brute_collocations(rows, least: int, most: int):
    sizes, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for width in (1, 2, 3):
                f.update((lang, *words[i:i + width]) for i in range(len(words) - width + 1))
    known = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for (lang, *p), a in known.items():
        if len(p) == 3:
            for q in (p[:2], p[1:]):
                inside[(lang, *q)] = max(inside[(lang, *q)], a)
    out = []
    for (lang, *p), a in known.items():
        if 100 * inside[(lang, *p)] >= 50 * a:
            continue
        cuts = [(1_000_000 * a * a // (f[(lang, *p[:k])] * f[(lang, *p[k:])]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[(lang, *p[:k])], f[(lang, *p[k:])], sizes[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    places = Counter()
    ranked = []
    for r in out:
        places[r[0]] += 1
        if places[r[0]] <= most:
            ranked.append((r[0], places[r[0]], *r[1:]))
    return ranked


@pytest.mark.parametrize("frequent", [collocations.FREQUENT, 3])
def test_collocations_by_brute_force(spark, small, monkeypatch, frequent):
    """With few frequent words and with stripes dealt over buckets; small chunks, so that stripes meet again."""
    monkeypatch.setattr(collocations, "FREQUENT", frequent)
    draw = random.Random(5)
    rows = [(draw.choice(["en", "en", None, "x y", ""]), "".join(draw.choice(["a", "a b", "A", "é", "b c", "\t", "\n", "a b c", "d."]) + " "
                                                                  for _ in range(draw.randrange(80)))) for _ in range(300)]
    docs = spark.createDataFrame([(i, lang, text, 1) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, f int")
    got = [tuple(r) for r in collocations.collocations(docs.repartition(7), least=4, most=25).collect()]
    assert sorted(got) == sorted(brute_collocations(rows, 4, 25))
    taken = common.table(spark, small, "documents").select("lang", "text").collect()
    want = brute_collocations([tuple(r) for r in taken], 10, 2000)
    assert sorted(map(tuple, queries.op12_collocations(spark, small).collect())) == sorted(want)


def test_collocation_chunks_of_any_size(spark, monkeypatch):
    rows = [("en", "a b a b, c " * 40), ("en", None), (None, "a b " * 30), ("en", ""), (None, None), ("en", "word " * 500 + "x" * 3000)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(1)
    want = sorted(brute_collocations(rows, 10, 2000))
    batches = docs.toArrow().select(["lang", "text"]).to_batches()
    assert want and sorted(map(tuple, collocations.collocations(docs).collect())) == want
    monkeypatch.setattr(collocations, "CHUNK", 16)
    full = [b.filter(b.column(0).is_valid()) for b in batches]
    assert [len(t) for _, t in collocations.chunks(iter(full))][:1] == [1]


def test_sorted_runs_of_wide_codes():
    import numpy as np
    draw = np.random.default_rng(3)
    columns = [draw.integers(0, 5, 200) for _ in range(3)]
    small, large = (collocations.summed(columns, None, size) for size in (5, 1 << 40))
    assert [a.tolist() for a in (*small[0], small[1])] == [a.tolist() for a in (*large[0], large[1])]


def test_collocations_odd_rows(spark):
    odd, empty = spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame([], SCHEMA)
    assert sorted(map(tuple, collocations.collocations(odd).collect())) == sorted(brute_collocations([(r[2], r[1]) for r in ODD], 10, 2000))
    assert collocations.collocations(empty).count() == 0


def brute_resample(docs, target, share=25):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    found = [(i, *features(text)) for i, text in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for text in target for b in features(text)[1])
    gains = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
             for b in range(10_000)]
    rows = []
    for i, words, f in found:
        weight = sum(gains[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = Counter()
    out = [(r[0], *r[2:], n) for n, r in enumerate(may[:share * len(may) // 100], 1)]
    drawn.update(r[:4] for r in out)
    for r in rows:
        key = (r[0], *r[2:])
        if drawn[key]:
            drawn[key] -= 1
        else:
            out.append((*key, None))
    return Counter(out)


def test_resampling_by_brute_force(spark, small):
    docs = [tuple(r) for r in common.table(spark, small, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in common.table(spark, small, "benchmark").collect()]
    assert Counter(map(tuple, queries.op13_resampling(spark, small).collect())) == brute_resample(docs, target)


@pytest.mark.parametrize("part", [8, resampling.PART])
def test_split_words_and_offsets(monkeypatch, part):
    """In pieces of any size the buckets are those of the whole text."""
    monkeypatch.setattr(resampling, "PART", part)
    for text in ["", " ", "one", "One  two\tthree-four", "é ü\x00ß 日本 a1 \U0001f600x", "x" * 100 + " y " + "z" * 50, "a b " * 40, "a" * 5 + "  " + "b" * 20]:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        count, buckets = resampling.feature_buckets(text)
        assert count == len(words)
        assert Counter(buckets.tolist()) == Counter(zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def test_resampling_odd_rows(spark):
    many = ODD + [(i, "some words stand here " * 8, "en", "a", 1, 1, "x") for i in (*range(20, 60), 21, 21, None)]
    docs, empty = spark.createDataFrame(many, SCHEMA), spark.createDataFrame([], SCHEMA)
    target = spark.createDataFrame([("some words",), (None,), ("",)], "text string")
    got = Counter(map(tuple, resampling.resample(docs, target).collect()))
    assert got == brute_resample([r[:2] for r in many], ["some words", None, ""])
    assert Counter(map(tuple, resampling.resample(docs, target.limit(0)).collect())) == brute_resample([r[:2] for r in many], [])
    assert resampling.resample(empty, target).count() == 0
    drawn = resampling.drawn_documents(docs.where("doc_id >= 20").dropDuplicates(["doc_id"]), target)
    assert drawn.columns == docs.columns and drawn.count() == 10

"""Personal data in disguise: texts are rewritten, scanned, and the spans mapped back to the source.

Transducers rewrite a text one after the other: homoglyphs (letters, digits and signs of other blocks
that look like ASCII, and characters without width), spelled digits, and words or bracketed signs that
stand for at, dot and plus. Each keeps, for every code point it writes, the span of source code points
that it stands for; a text without any sign of a disguise is not rewritten. Identifiers are detected in the source, these spans always stay, and in the
rewritten text; what is found there across at least one rewritten place is added, at its source span.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# The identifiers.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters and signs that look like ASCII and have no compatibility form there.
_LOOKS = {
    "АВЕКМНОРСТХУІЈЅԚԜаеорсхуіјѕһԁԛԝґв": "ABEKMHOPCTXYIJSQWaeopcxyijshdqwrb",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαεικνορτυχ": "ABEZHIKMNOPTYXaeikvoptux",
    "ıɑɡƖ": "iagl",
    "‐‑‒–—−﹣": "-------",
    "。․﹒·•": ".....",
    "﹢﹫": "+@",
}
#: Code points without width.
_HIDDEN = "­͏؜᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"
#: Digits in words, in the four languages of the corpus.
_DIGITS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
#: Words for the signs.
_AT, _DOT, _PLUS = "at|arobase|arroba|klammeraffe", "dot|punkt|point|punto", "plus|más"


_NUMBER = "|".join(sorted({v for w in _DIGITS for v in (w, "".join(c if c.isascii() else c.upper() for c in w))}, key=len, reverse=True))
_NUMBERS = re.compile(rf"(?:{_NUMBER})(?!\w)")
_BETWEEN_DIGITS = re.compile(r"[ \t\n,;-]{1,3}")
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGIT_LOOK = re.compile(r"[OoIl|](?=[0-9])")
_PLUS_WORD = re.compile(rf"(?:{_PLUS})[ \t-]{{1,2}}(?=[0-9])", re.IGNORECASE)
_BRACKETED = re.compile(rf"[\[({{<][ \t]*(?:(@|{_AT})|\.|{_DOT})[ \t]*[\])}}>]", re.IGNORECASE)
_ENTITY = re.compile(r"&(?:#0*64|#x0*40|commat|(#0*46|#x0*2e|period));", re.IGNORECASE)
_DOT_WORD = rf"[ \t]{{1,3}}(?:{_DOT})[ \t]{{1,3}}"
_DOT_WORDS = re.compile(_DOT_WORD, re.IGNORECASE)
_SIGN = re.compile(rf"[ \t](?:{_AT})[ \t]|@", re.IGNORECASE)
_BEFORE = re.compile(rf"(?:(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]{{1,64}}{_DOT_WORD}){{0,4}}[A-Za-z0-9._%+-]{{1,64}}$", re.IGNORECASE)
_LABEL = "[A-Za-z0-9-]{1,63}"
_END = r"[A-Za-z]{2,24}(?![A-Za-z0-9-])"
_AFTER_PLAIN = re.compile(rf"(?:{_LABEL}\.){{1,9}}{_END}")
_AFTER_WORDS = re.compile(rf"(?:{_LABEL}{_DOT_WORD}){{1,9}}{_END}", re.IGNORECASE)
#: The words for dot that may stand beside a word for at.
_BESIDE = {"at": {"dot", "punkt"}, "arobase": {"point"}, "arroba": {"punto"}, "klammeraffe": {"punkt"}}
#: Digit words of a text that may spell an identifier: an ip has four numbers.
FEW = 4
#: Code points in which a disguised local part is looked for.
_REACH = 400
_DOTTED_IP = re.compile(rf"[0-9]{{1,3}}(?:(?:\.|{_DOT_WORD})[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
#: Bytes of ASCII letters in lower case, anything else blank; and the last such run of each word, by which texts without them are known.
_TO_WORDS = bytes(c if 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_DIGIT_WORDS, _DOT_SET, _PLUS_WORDS = (
    frozenset(w.encode().translate(_TO_WORDS).split()[-1] for w in words.split("|")) for words in (_NUMBER, _DOT, _PLUS))


def emails(text: str) -> Iterator[Span]:
    """Every match of the pattern, found from its @ sign, so that long runs without one cost nothing."""
    done = -1  # end of the last match or place of the last sign, plus one
    at = text.find("@")
    while at >= 0:
        least = max(done, 0)
        start = least + len(text[least:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


_FINDERS: tuple[Callable[[str], Iterator[Span]], ...] = (emails, ips, cards, phones)


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all identifiers in ``text``, in that order."""
    return sorted((start, kind, end) for kind, find in enumerate(_FINDERS) for start, end in find(text))


@lru_cache(maxsize=1)
def _looks() -> dict[str, str]:
    known = {a: b for many, plain in _LOOKS.items() for a, b in zip(many, plain, strict=True)}
    return known | dict.fromkeys(_HIDDEN, "")


@lru_cache(maxsize=1 << 14)
def ascii_look(letter: str) -> str | None:
    """The ASCII character that ``letter`` looks like or stands for, empty if it has no width, None if there is none."""
    known = _looks().get(letter)
    if known is not None:
        return known
    plain = unicodedata.normalize("NFKC", letter)
    if len(plain) == 1 and plain != letter:
        return plain if plain.isascii() else _looks().get(plain)
    digit = unicodedata.decimal(letter, None)
    return None if digit is None else str(digit)


class Rewritten:
    """A text, and for each of its code points the source span that it stands for."""

    def __init__(self, source: str):
        self.source = self.text = source
        self.starts, self.ends = range(len(source)), range(1, len(source) + 1)

    def rewrite(self, places: list[tuple[int, int, str]]) -> None:
        """Replace ``text[start:end]`` of each (start, end, new): in order, apart, none of them empty."""
        if not places:
            return
        text, starts, ends, at = [], [], [], 0
        for start, end, new in places:
            text += [self.text[at:start], new]
            starts += [*self.starts[at:start], *[self.starts[start]] * len(new)]
            ends += [*self.ends[at:start], *[self.ends[end - 1]] * len(new)]
            at = end
        self.text = "".join([*text, self.text[at:]])
        self.starts, self.ends = starts + list(self.starts[at:]), ends + list(self.ends[at:])

    def added(self) -> Iterator[tuple[int, int, int]]:
        """(start, kind, end) in the source of the identifiers that hold a rewritten place."""
        if self.text == self.source:
            return
        for start, kind, end in identifiers(self.text):
            a, b = self.starts[start], self.ends[end - 1]
            if self.source[a:b] != self.text[start:end]:
                yield a, kind, b


def undo_homoglyphs(of: Rewritten) -> None:
    """Letters only in words that become ASCII as a whole, so that other scripts stay as they are."""
    if of.text.isascii():
        return
    looks = {c: look for c in set(of.text) if not c.isascii() and (look := ascii_look(c)) is not None}
    if not looks:
        return
    letters = {c: look for c, look in looks.items() if c.isalpha()}
    others = {c: look for c, look in looks.items() if c not in letters}
    if others:
        found = re.compile("[" + re.escape("".join(others)) + "]").finditer(of.text)
        of.rewrite([(*m.span(), others[m[0]]) for m in found])
    if letters:
        words = (m for m in _LETTERS.finditer(of.text) if not m[0].isascii() and all(c.isascii() or c in letters for c in m[0]))
        of.rewrite([(m.start() + i, m.start() + i + 1, letters[c]) for m in words for i, c in enumerate(m[0]) if c in letters])


def undo_spelled_digits(of: Rewritten) -> None:
    """Digit words become digits, where there are ``FEW`` at least or a digit stands beside; blanks and commas
    between two of them go."""
    lowered = of.text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found = [m for m in _NUMBERS.finditer(lowered) if not (m.start() and (lowered[m.start() - 1].isalnum() or lowered[m.start() - 1] == "_"))]
    joined = [0 < b.start() - a.end() <= 3 and _BETWEEN_DIGITS.fullmatch(lowered, a.end(), b.start()) is not None
              for a, b in zip(found, found[1:])]
    places = []
    for m, to_last in zip(found, [False, *joined]):
        start = m.start()
        beside = any(c in "0123456789" for c in lowered[max(0, start - 2):start] + lowered[m.end():m.end() + 2])
        if to_last and places and places[-1][1] >= start - 3:
            start = places[-1][1]
        if len(found) >= FEW or beside:
            places.append((start, m.end(), str(_DIGITS[m[0].lower()])))
    of.rewrite(places)


def undo_digit_looks(of: Rewritten) -> None:
    """Letters that look like 0 or 1 within digits."""
    def inside(m: re.Match) -> bool:
        before = of.text[max(0, m.start() - 2):m.start()]
        return before[-1:].isdigit() or (len(before) == 2 and before[0].isdigit() and before[1] in " .-")

    of.rewrite([(*m.span(), "0" if m[0] in "Oo" else "1") for m in _DIGIT_LOOK.finditer(of.text) if inside(m)])


def undo_signs(of: Rewritten) -> None:
    """Entities, and at and dot in brackets, with the blanks around them."""
    of.rewrite([(*m.span(), "." if m[1] else "@") for m in _ENTITY.finditer(of.text)])
    places, done = [], 0
    for m in _BRACKETED.finditer(of.text):
        start = done + len(of.text[done:m.start()].rstrip(" \t"))
        end = m.end()
        while of.text[end:end + 1] in (" ", "\t"):
            end += 1
        places.append((start, end, "@" if m[1] else "."))
        done = end
    of.rewrite(places)


def undo_words(of: Rewritten) -> None:
    """The words for at and dot without brackets, where a whole address stands around them: at as a word
    counts only beside a dot as a word. Dots between the parts of an ip, plus before a digit."""
    places, done = [], 0
    for m in _SIGN.finditer(of.text):
        start, end, word = m.start(), m.end(), m[0].strip().lower()
        while of.text[start - 1:start] in (" ", "\t") and start > max(done, m.start() - 3):
            start -= 1
        while of.text[end:end + 1] in (" ", "\t") and end < m.end() + 3:
            end += 1
        bare = word == "@" and end - start == 1
        if start < done or bare and _DOMAIN.match(of.text, start):
            continue
        plain = _AFTER_PLAIN.match(of.text, end) if word == "@" and not bare else None
        after = plain or _AFTER_WORDS.match(of.text, end)
        before = _BEFORE.search(of.text[max(done, start - _REACH):start]) if after else None
        if not before:
            continue
        dots = [(at + x.start(), at + x.end(), x[0].strip().lower()) for part, at in ((before[0], start - len(before[0])), (after[0], end))
                for x in _DOT_WORDS.finditer(part)]
        if word == "@" or all(d in _BESIDE[word] for *_, d in dots):
            places += sorted([(a, b, ".") for a, b, _ in dots] + ([] if bare else [(start, end, "@")]))
            done = after.end()
    of.rewrite(places)
    places = []
    for m in _DOTTED_IP.finditer(of.text):
        if not of.text[max(0, m.start() - 1):m.start()].isdigit():
            places += [(m.start() + x.start(), m.start() + x.end(), ".") for x in _DOT_WORDS.finditer(m[0])]
    of.rewrite(places)
    of.rewrite([(*m.span(), "+") for m in _PLUS_WORD.finditer(of.text) if not of.text[max(0, m.start() - 1):m.start()].isalnum()])


def deobfuscated(text: str) -> Rewritten:
    """``text`` without its disguises. Each step runs only where its words or signs occur at all."""
    of = Rewritten(text)
    undo_homoglyphs(of)
    if "[" in of.text or "(" in of.text or "{" in of.text or "<" in of.text or "&" in of.text:
        undo_signs(of)
    words = of.text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    known = set(words)
    if not known.isdisjoint(_DIGIT_WORDS):
        undo_spelled_digits(of)
    if any(d in of.text for d in "0123456789"):
        undo_digit_looks(of)
    dots = not known.isdisjoint(_DOT_SET)
    if "@" in of.text or dots or not known.isdisjoint(_PLUS_WORDS):
        undo_words(of)
    return of


def personal_data(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the identifiers as they stand, and of these and the disguised ones together.

    A disguised one is left out where an identifier of its kind as it stands covers it.
    """
    base = identifiers(text)
    of_kind = [[(a, b) for a, k, b in base if k == kind] for kind in range(len(KINDS))]

    def covered(start: int, kind: int, end: int) -> bool:
        at = bisect_right(of_kind[kind], start, key=lambda span: span[0])  # spans of a kind lie apart, in order
        return at > 0 and end <= of_kind[kind][at - 1][1]

    more = [span for span in deobfuscated(text).added() if not covered(*span)]
    return base, sorted({*base, *more})


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_FOUND = T.StructType([*[T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS], T.StructField("base_sha256", T.StringType()),
                       T.StructField("spans", T.StringType()), T.StructField("n_disguised", T.LongType())])


@F.pandas_udf(_FOUND)
def found_in(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for text in batch:
            base, every = personal_data(text)
            counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
            rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(every), len(every) - len(base)))
        yield pd.DataFrame(rows, columns=_FOUND.names, index=batch.index)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_disguised.

    The counts and the digest are of the identifiers as they stand in the text, ``spans`` lists these and
    the disguised ones as kind:start:end in code points, by start, kind and end, ``n_disguised`` says how
    many of them are disguised. A missing text is empty, a text without identifiers has an empty list,
    repeated rows and missing ids stay, an empty table gives no rows. Other columns are not looked at.
    Texts are judged where they are, one at a time and whole; nothing is moved.
    """
    return docs.select("doc_id", found_in(F.coalesce("text", F.lit(""))).alias("found")).select("doc_id", "found.*")


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series) -> pd.Series:
    def mask(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for start, kind, end in personal_data(text)[1]:
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind]}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    return texts.map(mask)


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with each identifier, disguised or not, replaced by its kind in brackets: what overlaps is one place."""
    return docs.withColumn("text", _masked("text"))

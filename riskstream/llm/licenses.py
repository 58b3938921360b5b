"""Licence scan by canonical digests: whole texts, paragraphs and lines are brought to one spelling,
digested, and joined to the digests of known licence texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from importlib.resources import files
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Licences and the notices by which they are known, one per wording.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
)

#: Headings that the short licences stand under, or under none.
HEADINGS = {
    "MIT": ("MIT", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC", "ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "BSD License", "New BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
}


def wordings(name: str, text: str) -> set[str]:
    """The whole licence ``text`` as it is found: with and without heading, clause numbers and a line of
    reserved rights, its links in either scheme, its terms with and without what follows their end."""
    bodies = {text}
    if name in HEADINGS:
        bodies.add(re.sub(r"(?m)^\s*\d\.\s", "* ", text))
        return {"\n\n".join(part for part in (heading, rights, body) if part)
                for body in bodies for heading in ("", *HEADINGS[name]) for rights in ("", "All rights reserved.")}
    terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
    bodies |= {terms, terms + end}
    return {re.sub("https?://", scheme, body) for body in bodies for scheme in ("http://", "https://")} | bodies


def whole_texts() -> Iterator[tuple[str, str]]:
    """(license, text) of the whole licences in ``license_texts``, files named ``<license>[~<number>].txt``."""
    for file in sorted(files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name):
        if file.name.endswith(".txt"):
            name, text = file.name[:-4].partition("~")[0], file.read_text(encoding="utf-8")
            yield from ((name, wording) for wording in sorted(wordings(name, text)))


#: Notices and whole texts.
KNOWN = NOTICES + tuple(dict.fromkeys(whole_texts()))

#: Spellings that count as equal, after case and punctuation; each left one becomes the right one.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("sub licensed", "sublicensed"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("catalogue", "catalog"),
    ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("merchantibility", "merchantability"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "wilfull"),
    ("non commercial", "noncommercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("v3", "version 3"), ("v2 0", "version 2 0"),
)

#: A line that only says whose the text is.
COPYRIGHT_LINE = "(?mi)^[^\\p{L}\\p{N}\\n]*(copyright|©|\\(c\\))[^\\n]*\\d{4}[^\\n]*$"
_MARKS = ("copyright", "©", "(c)")
_OWNED = re.compile(r"[\W_]*(?:copyright|©|\(c\)).*[0-9]{4}")
_BETWEEN = re.compile(r"[\W_]+")
#: Each ASCII byte as it counts in a word: letters lower-cased, digits, blanks for the rest.
_PLAIN = bytes(b if chr(b).isalnum() else 32 for b in bytes(range(128)).lower()) + bytes(128)
_BLANK = " \t\n\x0b\f\r"


def line_words(line: str) -> list[str]:
    """The words of a lower-case line: runs of letters and digits; a copyright line has none."""
    if any(mark in line for mark in _MARKS) and _OWNED.match(line):
        return []
    plain = line.encode().translate(_PLAIN).decode() if line.isascii() else _BETWEEN.sub(" ", line)
    return plain.split()


def canonical(lines: list[list[str]]) -> str:
    """The words of all lines in one spelling, with single blanks."""
    spelled = "  ".join([word for line in lines for word in line])  # between two words each has its own blank
    spelled = f" {spelled} "
    for other, one in EQUIVALENT:
        if other.partition(" ")[0] in spelled:
            spelled = spelled.replace(f" {other.replace(' ', '  ')} ", f" {one.replace(' ', '  ')} ")
    return spelled.replace("  ", " ").strip()


def text_units(text: str) -> list[list[list[str]]]:
    """The whole text, its paragraphs if there are empty lines within, and its lines if there are
    several, each as the word lists of its lines. The text is split into words once."""
    raw = text.lower().split("\n")
    words = [line_words(line) for line in raw]
    units = [words]
    if len(raw) > 1:
        empty = [not line.strip(_BLANK) for line in raw]
        if any(empty[1:-1]):
            units += [[words[i] for i in group] for blank, group in groupby(range(len(raw)), empty.__getitem__) if not blank]
        units += [[line] for line in words]
    return units


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def unit_digests(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The digest of each unit of each text, the whole text's first."""
    for batch in texts:
        yield pd.Series([[sha256(canonical(unit).encode()).digest() for unit in text_units(text)] for text in batch],
                        index=batch.index, dtype="object")


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """(digest, license) of the known texts, one row per digest (the first license in code point order)."""
    frame = spark.createDataFrame(list(known), "license string, text string")
    return frame.groupBy(unit_digests("text")[0].alias("digest")).agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, license, licenses, n_matches) per row of ``docs`` (doc_id, text).

    ``license`` is that of the whole text, else null; ``licenses`` lists in order, comma-joined, those
    of the whole text, of its paragraphs (between empty lines) and of its lines; ``n_matches`` counts
    the matching units. Missing and empty texts match nothing, nor do texts without letters or
    digits. Rows equal in id and text have equal results.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("key", F.xxhash64("text"))
    found = (rows.select("doc_id", "key", F.posexplode(unit_digests("text")).alias("at", "digest"))
             .join(known, "digest").select("doc_id", "key", "at", "license").distinct()
             .groupBy("doc_id", "key").agg(
                 F.min(F.when(F.col("at") == 0, F.col("license"))).alias("license"),
                 F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
                 F.count("*").alias("n_matches"))
             .toDF("found_id", "found_key", "license", "licenses", "n_matches"))
    narrow = rows.select("doc_id", "key")
    return (narrow.join(found, narrow["doc_id"].eqNullSafe(found["found_id"]) & (narrow["key"] == found["found_key"]), "left")
            .select("doc_id", "license", F.coalesce("licenses", F.lit("")).alias("licenses"),
                    F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches")))

"""Byte-level BPE encoding and decoding of whole texts, long ones by tree concatenation.

A long text is halved until its pieces are short. The pieces are encoded on their own, those of very
long documents in other tasks, and neighbours are joined pairwise up the tree: a window of tokens on
both sides of the join is encoded anew, and grows until it begins with the left side's tokens and
ends with the right side's. A token sequence is the encoding of its text if every neighbouring pair
is, so from there on both sides stand as they are.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import free_name, written

#: Code points of a piece encoded at once; of a document that is dealt over tasks, and of its shares.
PIECE, LONG, PART = 8_192, 65_536, 32_768
#: Tokens that must agree on each side of a join, and tokens of the first window's sides.
AGREE, SIDE = 4, 16
#: Fixed value: the pattern by which this kind of vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of a ``tokenizers`` file of the byte-level BPE kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE file")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranks = [model["vocab"]["".join(m)] for m in merges]
        if ranks != sorted(ranks):
            raise ValueError("merges are not in the order of their ids")
        self.encoder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=plain, special_tokens=added)
        self.special = sorted(added)
        size = max([*plain.values(), *added.values()]) + 1
        self.bytes = [b""] * size
        for token, i in [*plain.items(), *((t.encode(), i) for t, i in added.items())]:
            self.bytes[i] = token
        self.names = [str(i) for i in range(size)]

    def encode_piece(self, text: str) -> list[int]:
        return self.encoder.encode(text, allowed_special="all", disallowed_special=())

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE:
            return self.encode_piece(text)
        cut = self.cut(text)
        return self.join(self.encode(text[:cut]), self.encode(text[cut:]))

    def cut(self, text: str) -> int:
        """The middle, moved off a special token's text."""
        cut = len(text) // 2
        for token in self.special:
            at = text.find(token, max(0, cut - len(token) + 1), cut + len(token) - 1)
            if at >= 0 and at < cut < at + len(token):
                cut = at or len(token)
        return cut

    def join(self, left: list[int], right: list[int]) -> list[int]:
        side = SIDE
        while True:
            a, b = left[-side:], right[:side]
            whole = len(a) == len(left), len(b) == len(right)
            data = b"".join([self.bytes[i] for i in a + b])
            try:
                window = self.encode_piece(data.decode("utf-8"))
            except UnicodeDecodeError:  # a side begins or ends inside a code point
                window = None
            if window is not None:
                agree = min(AGREE, len(window))
                starts = whole[0] or window[:agree] == a[:agree]
                ends = whole[1] or window[-agree:] == b[-agree:]
                if starts and ends:
                    return left[: len(left) - len(a)] + window + right[len(b):]
            side *= 2

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        listed = ",".join(map(self.names.__getitem__, ids))
        return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def shares(text: str, most: int, cutter) -> list[str]:
    """Leaves of the tree: halves of halves, none longer than ``most``."""
    if len(text) <= most:
        return [text]
    cut = cutter(text)
    return shares(text[:cut], most, cutter) + shares(text[cut:], most, cutter)


def joined(parts: list[list[int]], join) -> list[int]:
    while len(parts) > 1:
        parts = [join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` with n_tokens, ids_sha256 and decoded_sha256 (longer names where ``docs`` has
    these) of each whole text (null: empty), encoded with the file at ``path`` as its own library does
    without added special tokens, and decoded with special tokens kept. Repeated rows stay, an empty
    table gives an empty one.

    Documents up to ``LONG`` code points stay where they are. Of longer ones, equal texts are encoded
    once: their shares are dealt over all tasks, and the ids of one text meet again in one task, which
    is no more than the text's own row was. ``path`` is read on every executor.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(kind)
    def encode_whole(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = [codec(path).digests(codec(path).encode(t)) for t in batch]
            yield pd.DataFrame(rows, columns=names)

    @F.pandas_udf("array<string>")
    def split_shares(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shares(t, PART, codec(path).cut))

    @F.pandas_udf("binary")
    def encode_share(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: np.array(codec(path).encode(t), dtype="<i4").tobytes())

    def join_shares(group: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(b, dtype="<i4").tolist() for b in group.sort_values("place")["ids"]]
        found = codec(path).digests(joined(parts, codec(path).join))
        return pd.DataFrame([(group["key"].iloc[0], *found)], columns=["key", *names])

    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.length("text") > LONG
    short = packed.where(~long).select("row", encode_whole("text").alias("tokens"))
    whole = written(packed.where(long).withColumn("key", F.sha2("text", 256)), "long")
    parts = (whole.select("key", split_shares("text").alias("s")).select("key", F.posexplode("s").alias("place", "share"))
             .groupBy("key", "place").agg(F.first("share").alias("share"))
             .select("key", "place", encode_share("share").alias("ids")))
    encoded = parts.groupBy("key").applyInPandas(join_shares, f"key string, {kind}")
    found = whole.join(encoded, "key").select("row", F.struct(*names).alias("tokens"))
    return short.union(found).select("row.*", *[F.col(f"tokens.{c}").alias(free_name(c, docs)) for c in names])


def token_report(docs: DataFrame, path: str) -> DataFrame:
    return token_digests(docs.select("doc_id", "text"), path).drop("text")

"""Byte-level BPE encoding and decoding of whole texts by tree concatenation.

A text longer than ``piece_chars`` is cut into pieces, which tasks encode in parallel. The
encodings are joined in pairs, halves of halves, up to the whole text: around each join a
window is encoded anew and grows until it agrees with both sides: until on either side it
begins or ends, between two tokens, at a place where the splitting pattern separates words
whatever stands around them, or at the end of the text. No merge reaches over such a place, so
the result equals that of encoding the text at once. That the same token stands on both sides
of a place is not enough, as the next character may change where a run of blanks is split.

Most pieces go through a fast implementation of the same vocabulary. Pieces with characters
on whose classes the two libraries could differ go through the tokenizers library itself.
Strings of special tokens in a text become those tokens, as they do there.

Defined results: a null text is an empty one, without tokens. Equal long texts are encoded
once. Decoding replaces bytes that are no UTF-8 with U+FFFD. Repeated rows and null ids stay
as they are; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import then_release

DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Fixed value: the pattern of this vocabulary that splits a text into words.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: Characters that have had their class in every version of Unicode the libraries may follow.
_STABLE = regex.compile(r"[\u0000-ɏ‐-‧€]*")


class Codec:
    """One vocabulary. vocabulary: a tokenizers file; ranks: the same as a rank file, or None."""

    def __init__(self, vocabulary: str, ranks: str | None):
        import tiktoken

        self.vocabulary = vocabulary
        with open(vocabulary, encoding="utf-8") as file:
            self.special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.fast = None
        if ranks:
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "own", pat_str=PATTERN, mergeable_ranks=table, special_tokens=self.special
            )
            self.bytes_of = {i: b for b, i in table.items()}
        else:
            back = {c: b for b, c in _byte_characters().items()}
            self.bytes_of = {
                i: bytes(back[c] for c in t)
                for t, i in self.whole.get_vocab().items()
                if t not in self.special
            }
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}

    @cached_property
    def whole(self):
        """The library's own encoder; most tasks never need it."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.vocabulary)
        found.no_truncation()
        found.no_padding()
        return found

    def _plain(self, text: str) -> list[int]:
        if not text:
            return []
        if self.fast and _STABLE.fullmatch(text):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        """The ids of a text that is encoded at once."""
        if not self.cut or not self.cut.search(text):
            return self._plain(text)
        ids, at = [], 0
        for m in self.cut.finditer(text):
            ids += self._plain(text[at : m.start()])
            ids.append(self.special[m[0]])
            at = m.end()
        return ids + self._plain(text[at:])

    def to_bytes(self, ids: list[int]) -> bytes:
        if self.fast:
            return self.fast.decode_bytes(ids)
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.to_bytes(ids).decode("utf-8", "replace")

    def pieces(self, text: str, piece_chars: int) -> list[str]:
        """Cut at fixed places, but never inside the string of a special token."""
        cuts, at = [0], piece_chars
        inside = [m.span() for m in self.cut.finditer(text)] if self.cut else []
        k = 0
        while at < len(text):
            while k < len(inside) and inside[k][1] <= at:
                k += 1
            place = inside[k][0] if k < len(inside) and inside[k][0] < at else at
            if place > cuts[-1]:
                cuts.append(place)
            at += piece_chars
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]

    def join(self, left: tuple[str, list[int]], right: tuple[str, list[int]], window: int = 16):
        """The text and ids of both, by encoding growing windows around the place of the join."""
        (lt, li), (rt, ri) = left, right
        if not lt or not rt:
            return lt + rt, li + ri
        while True:
            a, b = max(0, len(li) - window), min(len(ri), window)
            while a and _inside_character(self.bytes_of[li[a]]):
                a -= 1
            while b < len(ri) and _inside_character(self.bytes_of[ri[b]]):
                b += 1
            start = len(lt) - len(self.to_bytes(li[a:]).decode())
            end = len(self.to_bytes(ri[:b]).decode())
            p = (a, start) if a == 0 else self._safe(lt, start, li[a:], a)
            q = (b, end) if b == len(ri) else self._safe(rt, 0, ri[:b], 0, first=True)
            if p and q:
                (a, start), (b, end) = p, q
                return lt + rt, li[:a] + self.encode(lt[start:] + rt[:end]) + ri[b:]
            window *= 2

    def _safe(self, text: str, at: int, ids: list[int], n: int, first: bool = False):
        """(tokens before it, place) of the last or first safe place between tokens; ids are
        those from place ``at`` on, with n tokens before. None if there is none."""
        found, pending = None, b""
        for token in ids[:-1]:
            n += 1
            pending += self.bytes_of[token]
            try:
                at += len(pending.decode())
            except UnicodeDecodeError:
                continue  # the token ends inside a character
            pending = b""
            if _safe_place(text, at):
                found = n, at
                if first:
                    break
        return found

    def tree(self, parts: list[tuple[str, list[int]]]) -> tuple[str, list[int]]:
        """Joins neighbours until one is left."""
        while len(parts) > 1:
            pairs = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
            parts = pairs + parts[len(parts) - len(parts) % 2 :]
        return parts[0] if parts else ("", [])

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        text = ",".join(map(str, ids))
        decoded = self.decode(ids).encode()
        return len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


# The bytes that vocabularies of this kind write as themselves.
def _byte_characters() -> dict[int, str]:
    """The visible character by which vocabularies of this kind write each byte."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _inside_character(token: bytes) -> bool:
    return token[0] & 0xC0 == 0x80


_kinds = [(regex.compile(r"\s"), "space"), (regex.compile(r"\p{L}"), "letter"), (regex.compile(r"\p{N}"), "number")]


@lru_cache(maxsize=100_000)
def _kind(char: str) -> str:
    """The class of a character in the pattern, or 'unsure' if libraries may differ on it: it is
    new, or its class has changed, or it is a control character that only some take for a space."""
    old, new = unicodedata.ucd_3_2_0.category(char), unicodedata.category(char)
    changed = old[0] != new[0] and {old[0], new[0]} & {"L", "N", "Z"}
    if old == "Cn" or changed or "\x1c" <= char <= "\x1f":
        return "unsure"
    return next((name for found, name in _kinds if found.match(char)), "other")


def _safe_place(text: str, at: int) -> bool:
    """Whether the pattern ends a word before this place in any context: behind a character
    that is no space and before one of another kind, but not before a letter behind an
    'other', which may be one word as in 's."""
    before, after = _kind(text[at - 1]), _kind(text[at])
    if "unsure" in (before, after):
        return False
    return before not in ("space", after) and (before, after) != ("other", "letter")


def _digest_udf(vocabulary: str, ranks: str | None):
    @F.pandas_udf(DIGEST)
    @then_release
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocabulary, ranks)
        for texts in batches:
            yield pd.DataFrame(
                [codec.digest(codec.encode(t or "")) for t in texts],
                columns=["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest


def _long_ids(docs: DataFrame, vocabulary: str, ranks: str | None, piece_chars: int) -> DataFrame:
    """(key, ids) of each different text of docs, piece by piece and joined."""

    @F.pandas_udf("array<string>")
    @then_release
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(vocabulary, ranks)
        for texts in batches:
            yield pd.Series([codec.pieces(t, piece_chars) for t in texts])

    @F.pandas_udf("array<int>")
    @then_release
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(vocabulary, ranks)
        for texts in batches:
            yield pd.Series([np.array(codec.encode(t), np.int32) for t in texts])

    @then_release
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocabulary, ranks)
        for key, parts in _by_key(batches):
            ids = codec.tree(parts)[1]
            yield pd.DataFrame({"key": [key], "ids": [np.array(ids, np.int32)]})

    pieces = (
        docs.select(F.sha2("text", 256).alias("key"), F.posexplode(cut("text")).alias("pos", "piece"))
        .dropDuplicates(["key", "pos"])  # deals the pieces out, equal texts once
        .withColumn("ids", encode("piece"))
    )
    whole = pieces.repartition("key").sortWithinPartitions("key", "pos")
    return whole.mapInPandas(join, "key string, ids array<int>")


def _by_key(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list]]:
    """The (piece, ids) of one key after the other, from rows sorted by key."""
    now, parts = None, []
    for batch in batches:
        for key, piece, ids in zip(batch["key"], batch["piece"], batch["ids"], strict=True):
            if key != now and parts:
                yield now, parts
                parts = []
            now = key
            parts.append((piece, ids.tolist()))
    if parts:
        yield now, parts


def encoded(
    docs: DataFrame, vocabulary: str, ranks: str | None = None, *, piece_chars: int = 32768
) -> DataFrame:
    """(doc_id, ids array<int>), a row for each row of docs."""

    @F.pandas_udf("array<int>")
    @then_release
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(vocabulary, ranks)
        for texts in batches:
            yield pd.Series([np.array(codec.encode(t or ""), np.int32) for t in texts])

    short, long, key = _by_length(docs, piece_chars)
    joined = long.join(_long_ids(long, vocabulary, ranks, piece_chars), key).select("doc_id", "ids")
    return short.select("doc_id", encode("text").alias("ids")).unionByName(joined)


def decoded(rows: DataFrame, vocabulary: str, ranks: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids are no tokens."""

    @F.pandas_udf("string")
    @then_release
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(vocabulary, ranks)
        for ids in batches:
            yield pd.Series([codec.decode([] if i is None else list(i)) for i in ids], dtype=object)

    return rows.select("doc_id", decode("ids").alias("text"))


def _by_length(docs: DataFrame, piece_chars: int) -> tuple[DataFrame, DataFrame, str]:
    rows = docs.select("doc_id", "text")
    is_long = F.coalesce(F.char_length("text"), F.lit(0)) > piece_chars
    long = rows.where(is_long).withColumn("key", F.sha2("text", 256))
    return rows.where(~is_long), long, "key"


def token_digests(
    docs: DataFrame, vocabulary: str, ranks: str | None = None, *, piece_chars: int = 32768
) -> DataFrame:
    """Per row of docs the number and digest of its ids and the digest of their decoding."""

    @F.pandas_udf(DIGEST)
    @then_release
    def of_ids(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocabulary, ranks)
        for lists in batches:
            yield pd.DataFrame(
                [codec.digest(i.tolist()) for i in lists],
                columns=["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    short, long, key = _by_length(docs, piece_chars)
    ids = _long_ids(long, vocabulary, ranks, piece_chars).select(key, of_ids("ids").alias("d"))
    rows = short.select("doc_id", _digest_udf(vocabulary, ranks)("text").alias("d")).unionByName(
        long.select("doc_id", key).join(ids, key).select("doc_id", "d")
    )
    return rows.select("doc_id", "d.*")

"""Encoding against the tokenizers library, also where texts are cut and joined."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from arrivals_engine.llm import bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(VOCABULARY, RANKS)


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(VOCABULARY)
    return lambda text: found.encode(text, add_special_tokens=False).ids


def random_text(rng: random.Random, n: int) -> str:
    parts = ["the ", " of", "it's", "'s", "'", "  ", "\n", "\n\n", " \t", "aaaaaaaa", "zqxj", "1234", "!!"]
    parts += ["é", "ßä", "日本語", "🙂", "<|endoftext|>", "<|endo", " ", "\x85", "''ll", ".", "...", "ǅ", "½", "​"]
    kind = rng.choice(["mixed", "letters", "spaces", "marks"])
    if kind == "letters":
        parts = ["a", "b", "the", "ing", "xq"]
    elif kind == "spaces":
        parts = [" ", "  ", "\n", "\t", " "]
    elif kind == "marks":
        parts = ["!", "'", "#", "--", "s", "'re"]
    return "".join(rng.choice(parts) for _ in range(n))


@pytest.mark.parametrize("seed", range(60))
def test_joined_pieces_equal_the_whole(codec, library, seed):
    rng = random.Random(seed)
    text = random_text(rng, rng.randrange(1, 400))
    for piece_chars in (1, 3, 7, 50):
        parts = [(p, codec.encode(p)) for p in codec.pieces(text, piece_chars)]
        assert "".join(p for p, _ in parts) == text
        assert codec.tree(parts) == (text, library(text))
    assert codec.decode(library(text)) == text


ALPHABETS = [
    ["\x85", " ", "\u200b", "'", "x", "\t"],
    ["\x1c", "!", "1", "a", " ", "\u2028", "\u180e"],
    ["'", "s", "ll", "1", " ", "\n", "it"],
    ["日", "本", "。", "１", "\u3000", "a", "🙂", "\ufe0f", "\u0301"],
    ["ꟊ", "\U00011f00", "\u20c0", "a", "1", "!", " "],
    ["<|", "endoftext", "|>", "<|endoftext|>", " ", "|"],
]


@pytest.mark.parametrize("window", [1, 16])
@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_joins_are_exact_with_any_window(codec, library, alphabet, window):
    rng = random.Random(window)
    for _ in range(450):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 90)))
        parts = [(p, codec.encode(p)) for p in codec.pieces(text, rng.randrange(1, 9))]
        while len(parts) > 1:
            pairs = [codec.join(x, y, window) for x, y in zip(parts[::2], parts[1::2], strict=False)]
            parts = pairs + parts[len(parts) - len(parts) % 2 :]
        assert parts[0] == (text, library(text)), repr(text)


def test_joins_at_the_usual_size(codec, library):
    rng = random.Random(0)
    for alphabet in (*ALPHABETS, ["the ", "of", "  ", "\n", "word", "1,000", " (a)"]):
        text = "".join(rng.choice(alphabet) for _ in range(40_000))
        parts = [(p, codec.encode(p)) for p in codec.pieces(text, 32768)]
        assert len(parts) > 1 and codec.tree(parts) == (text, library(text))


def test_the_fast_way_agrees_on_every_character_it_takes(codec, library):
    chars = [chr(c) for c in range(0x110000) if bpe._STABLE.fullmatch(chr(c))]
    assert len(chars) > 500
    for c in chars:
        for text in (c, f"a{c}b", f"1{c}{c} ", f" {c}'s", f"!{c}\n{c}"):
            assert codec.encode(text) == library(text), repr(text)


def expected(library, text):
    ids = library(text or "")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(ids), digest(",".join(map(str, ids))), digest(text or "")


def test_documents_of_every_kind(spark, library):
    long = "word " * 300 + "x" * 500 + " 'tis\n" * 100 + "<|endoftext|>" * 30
    texts = [None, "", "a", long, long, "日本" * 200, " " * 333, "y" * 1000]
    rows = [(None if i == 2 else i % 5, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    got = bpe.token_digests(docs, VOCABULARY, RANKS, piece_chars=100).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = [(d, *expected(library, t)) for d, t, _ in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)

    ids = bpe.encoded(docs, VOCABULARY, RANKS, piece_chars=100)
    back = bpe.decoded(ids, VOCABULARY, RANKS).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for t in texts)
    assert bpe.token_digests(docs.limit(0), VOCABULARY, RANKS).collect() == []


def test_without_rank_file_and_with_broken_bytes(codec):
    slow = bpe.Codec(VOCABULARY, None)
    assert slow.encode("it's ré!") == codec.encode("it's ré!")
    broken = [i for i, b in codec.bytes_of.items() if b == b"\xc3"]
    assert slow.decode(broken) == codec.decode(broken) == "�"

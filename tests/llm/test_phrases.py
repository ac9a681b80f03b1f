"""Collocations against a plain count of all n-grams."""

import random
import re
from collections import Counter

import pytest

from arrivals_engine.llm import phrases
from arrivals_engine.llm.common import Scratch


def brute(rows, least, top):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, seen in counts.items():
        frequent = {p: n for p, n in seen.items() if len(p) > 1 and n >= least}
        found = []
        for p, a in frequent.items():
            inside = any(
                n >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, n in frequent.items()
            )
            if not inside:
                cuts = [(seen[p[:k]], seen[p[k:]], k) for k in range(1, len(p))]
                score, _, left, right = min((1000 * a * sizes[lang] // (x * y), k, x, y) for x, y, k in cuts)
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "nEw", "york", "a\x1cb", "ä", "Ä", "　", "z", "😀", "w1"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "\x0b", "!?", ";:"]
    rows = []
    for _ in range(120):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text + rng.choice(["", " new york city hall"])))
    rows += [("en", "new york city hall is open")] * 30 + [("en", None), (None, ""), ("en", " \t\n.,")]
    return rows + [("fr", "x x x x x x x x"), ("fr", "x x x")] * 9


@pytest.mark.parametrize(("least", "top", "most"), [(2, 2000, 500_000), (5, 7, 3), (9, None, 0), (10**6, 5, 1)])
def test_equal_to_all_ngrams(spark, least, top, most):
    rows = corpus(least)
    docs = spark.createDataFrame([(lang, t, 1, 2) for lang, t in rows], "lang string, text string, m int, piece int")
    found = phrases.collocations(docs.repartition(3), min_count=least, top=top, most_broadcast=most, salts=2)
    got = sorted(map(tuple, found.collect()))
    assert got == brute(rows, least, top)
    assert bool(got) == (least < 10**6)


def test_pairs_that_share_a_hash_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HASH_BITS", 1)
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, min_count=4).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 2000)


def test_products_beyond_64_bits_and_no_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    part = "lang string, phrase string, size int, f long"
    two = spark.createDataFrame([("en", "a b", 2, 10**12)], part)
    counts = spark.createDataFrame([("en", "a", 10**12 + 7), ("en", "b", 10**13 + 9)], "lang string, phrase string, f long")
    sizes = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    row = phrases._scored(two, counts, sizes).first()
    assert row["score"] == 1000 * 10**12 * 10**14 // ((10**12 + 7) * (10**13 + 9))


def test_windows_are_padded_where_words_are_rare(spark):
    docs = spark.createDataFrame([("en", "a b c d e f")] * 3 + [("en", "x a b y. c d e")], "lang string, text string")
    scratch = Scratch(spark, "test_phrases")
    windows = phrases._windows(phrases.piece_counts(docs), 3, scratch, 10)
    got = {tuple(r)[1:6]: r["f"] for r in windows.collect()}
    words = list("abcdef")
    want = {tuple((words[i : i + 5] + [""] * 5)[:5]): 3 for i in range(5)}
    assert got == want | {("a", "b", "", "", ""): 1, ("c", "d", "e", "", ""): 1, ("d", "e", "", "", ""): 1}

"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from arrivals_engine.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """(start, period, length), every period tried at every place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, q, k) for (s, k), q in found.items())


def brute_planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_digest(doc_id, words):
    found = brute_runs(words)
    gone = {i for s, q, k in found for i in range(s + q, s + k)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = sha("".join(f"{s},{k},{q}\n" for s, q, k in found))
    best = min(found, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    if best is None:
        return doc_id, 0, None, None, None, None, listed, sha(kept)
    s, q, k = best
    return doc_id, len(found), s, k, q, 1000 * k // q, listed, sha(kept)


def solved(words):
    """All tiles of one text, stitched without Spark."""
    ids = runs.numbered([w.encode() for w in words])
    marked = {}
    for tile in runs.tiles(ids):
        for q, lo, hi in runs.solve(*tile):
            marked.setdefault(q, set()).update(range(lo, hi))
    found = []
    for q, places in marked.items():
        for i in sorted(places):
            if i - 1 not in places:
                j = i
                while j in places:
                    j += 1
                if j - i + q >= max(6, 4 * q):
                    found.append((i, q, j - i + q))
    return sorted(found)


def random_words(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(0, 90))]
    if kind == 1:
        return [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 200))]
    base = [rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 40))]
    words = base * rng.randrange(1, 9) + base[: rng.randrange(len(base) + 1)]
    if kind == 3:  # runs within runs
        words = (words + ["x"] * rng.randrange(9)) * rng.randrange(1, 7)
    for _ in range(rng.randrange(3)):
        words[rng.randrange(len(words))] = "y"
    return [rng.choice("abc") for _ in range(rng.randrange(9))] + words


@pytest.mark.parametrize("together", [4096, 1, 24])
def test_tiles_find_all_runs(monkeypatch, together):
    monkeypatch.setattr(runs, "TOGETHER", together)
    monkeypatch.setattr(runs, "OBJECTS", 1 << 16 if together > 1 else 8)
    rng = random.Random(together)
    for _ in range(1500):
        words = random_words(rng)
        assert solved(words) == brute_runs(words), words


def test_boundaries_and_long_periods():
    for n in (5, 6, 7, 8, 64, 1000, 4097):
        assert solved(["a"] * n) == ([(0, 1, n)] if n >= 6 else [])
    for period in (2, 3, 31, 32, 33, 255, 256, 257):
        base = [f"w{i}" for i in range(period)]
        for shift in (0, 1, period):
            for extra in (-1, 0, 1):
                words = [f"x{i}" for i in range(shift)] + (base * 5)[: 4 * period + extra] + ["y"]
                want = [(shift, period, 4 * period + extra)] if extra >= 0 else []
                assert solved(words) == want


def test_equal_hashes_are_no_runs(monkeypatch):
    monkeypatch.setattr(runs, "_grams", lambda ids, size: np.zeros(max(0, len(ids) - size + 1), np.uint64))
    rng = random.Random(5)
    for _ in range(200):
        words = random_words(rng)
        assert solved(words) == brute_runs(words)


ROWS = [
    (None, "a a a a a a"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "x x x x x x"),
    (4, "x x x x x x"),
    (4, "y z y z y z y z y"),
    (5, "e b\x1c " * 9),
    (6, "Long é " * 3000),
]


@pytest.mark.parametrize("batch", [2, 1000])
def test_digests(spark, batch):
    rng = random.Random(batch)
    rows = ROWS + [(i, " ".join(random_words(rng))) for i in range(10, 150)]
    docs = spark.createDataFrame([(i, t, 7, "k") for i, t in rows], "doc_id long, text string, found int, _run_key string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = runs.run_digests(runs.planted(docs.repartition(4))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got) == order(brute_digest(i, brute_planted(i, t)) for i, t in rows)
    assert sum(r["n_runs"] > 0 for r in got) > 30
    assert runs.run_digests(runs.planted(docs.limit(0))).collect() == []


def test_other_columns_are_kept(spark):
    docs = spark.createDataFrame([(1, "b b b b b b b c", 9)], "doc_id long, text string, _run_key int")
    got = runs.with_runs(docs, "periodic").collect()
    assert [r.asDict(recursive=True) for r in got] == [
        {
            "doc_id": 1,
            "text": "b b b b b b b c",
            "_run_key": 9,
            "periodic": {"runs": [{"start": 0, "period": 1, "length": 7}], "collapsed": "b c"},
        }
    ]
    with pytest.raises(ValueError):
        runs.with_runs(docs, "text")

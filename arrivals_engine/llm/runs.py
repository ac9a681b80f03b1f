"""Periodic run detection, tiled by scale.

A run of period q is a stretch of words in which words q apart are equal, that no neighbour
extends, that has no smaller period and at least ``max(6, 4 q)`` words. Periods are searched
by octaves ``scale <= q < 2 scale``. For each octave a text has a boundary at every 2 scale
words, so every run has one among the words that are equal to the word q further on; around
each boundary stands a tile of 2 scale words before and 4 scale words from it on, so that
neighbouring tiles overlap. Tiles are dealt out, some neighbours together, and each is solved by
itself: Z-functions of the words from the boundary on and, backwards, of the words before it
give for all periods of the octave how far equality reaches to both sides. What is long enough,
or reaches the next boundary, is a fragment; fragments are shuffled by document and period and
stitched where they meet.

Tiles that cannot touch a run are not sent: at least ``max(5, 3 q)`` words in a row around the
boundary equal the word q further on, so half as many on one side do, and hashes of some words
in a row must repeat at a distance of the octave. Equal hashes of different words only cost
time. A period whose divisor holds for the whole fragment is left to the octave of the divisor.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. Defined results: a null or empty text, and
one of fewer than six words, has no runs; its collapsed text is its words joined by one space.
Rows are taken by id and text, so repeated rows, null ids and ids with several texts all get
their own answer. Other columns are kept, whatever their names. An empty table gives no rows.
A very long text is split into words by one task, which needs some times its size; its tiles
go to all tasks, the largest with as many words as the text has. Runs of a text are fewer than
its words and are gathered in its row.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from arrivals_engine.llm.common import free_name, partitions

LEAST_WORDS, LEAST_TIMES = 6, 4
RUNS = "array<struct<start:long,period:long,length:long>>"
TILES = "key string, scale long, first long, bounds array<long>, words binary"
FRAGMENT = "key string, period long, lo long, hi long"
#: Tiles that lie together are sent together up to so many words, one tile at least; words are
#: sent as numbers, so many bytes at a time.
TOGETHER, BATCH_BYTES = 4096, 4 << 20
#: Longer rows of numbers are not made objects, which take nine times the memory.
OBJECTS = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """split() of bytes takes blanks, tabs, line ends and form feeds, as [\\x20\\x09-\\x0D]."""
    return (text or "").encode().split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


# ---- tiles ----------------------------------------------------------------


def _grams(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of so many words in a row."""
    count = max(0, len(ids) - size + 1)
    mixed = np.zeros(count, np.uint64)
    for k in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + count].astype(np.uint64)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _repeated(grams: np.ndarray, at: np.ndarray, scale: int) -> np.ndarray:
    """Whether the gram at each place is there again, scale to 2 scale - 1 words further on."""
    ahead = np.arange(scale, 2 * scale)
    found = np.zeros(len(at), bool)
    rows = max(1, (1 << 20) // scale)
    for i in range(0, len(at), rows):
        part = at[i : i + rows]
        places = part[:, None] + ahead
        same = grams[np.minimum(places, len(grams) - 1)] == grams[part][:, None]
        found[i : i + rows] = (same & (places < len(grams))).any(axis=1)
    return found


def tiles(ids: np.ndarray) -> Iterator[tuple[int, int, list[int], np.ndarray]]:
    """(scale, first, bounds, words): the tiles that may touch a run, by their boundaries. first
    is the place of the first of the words that they cover."""
    n = len(ids)
    fives = _grams(ids, 5)
    if n < LEAST_WORDS or len(np.unique(fives)) == len(fives):
        return
    scale = 1
    while max(LEAST_WORDS, LEAST_TIMES * scale) <= n:
        size = 3 if scale <= 2 else 6  # at most half of max(5, 3 scale), rounded up
        grams = _grams(ids, size)
        step = 2 * scale
        bounds = np.arange(0, n - scale, step)
        touched = np.zeros(len(bounds), bool)
        for shift in (0, -size):
            inside = (bounds + shift >= 0) & (bounds + shift < len(grams))
            touched[inside] |= _repeated(grams, bounds[inside] + shift, scale)
        found = np.flatnonzero(touched)
        most = max(1, TOGETHER // step)
        # Places where a new group of tiles begins: after a gap, and in front of full blocks.
        new = np.flatnonzero((np.diff(found) > 1) | (found[1:] // most != found[:-1] // most)) + 1
        for group in np.split(bounds[found], new) if len(found) else []:
            first = max(0, int(group[0]) - step)
            yield scale, first, group.tolist(), ids[first : int(group[-1]) + 2 * step]
        scale = step


def _tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["key", "scale", "first", "bounds", "words"]
    for batch in batches:
        rows, size = [], 0
        for key, text in zip(batch["key"], batch["text"], strict=True):
            for scale, first, bounds, words in tiles(numbered(words_of(text))):
                rows.append((key, scale, first, bounds, words.tobytes()))
                size += words.nbytes
                if size > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        yield pd.DataFrame(rows, columns=columns)


# ---- solving tiles --------------------------------------------------------


def z_function(s: list[int] | array) -> list[int] | array:
    """For each place how many words from there on are the same as at the beginning."""
    n = len(s)
    z = [0] * n if n < OBJECTS else array("i", bytes(4 * n))
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _prime_divisors(n: int) -> list[int]:
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return [*found, n] if n > 1 else found


def fragments(scale: int, before: int, words: list[int] | array) -> list[tuple[int, int, int]]:
    """(period, back, on): so many words before and from the boundary on equal those one period
    further on. Only those that may be, or be part of, a run with just this period. The
    boundary is behind the first ``before`` words of the tile."""
    step = 2 * scale
    ahead = z_function(words[before:])
    turned = words[: before + step][::-1]
    start = words[:before][::-1]
    start.append(-1)  # no word
    back = z_function(start + turned)
    # The words before the boundary plus q begin, backwards, so far from the end of back.
    zero = len(back) - before
    found = []
    for q in range(scale, min(step, len(words) - before)):
        ago = back[zero - q] if before else 0
        if ago < step and ahead[q] < step and ago + ahead[q] < max(LEAST_WORDS - 1, (LEAST_TIMES - 1) * q):
            continue
        on, ago = min(ahead[q], step), min(ago, step)
        shorter = (q // prime for prime in _prime_divisors(q))
        if not any(ahead[p] >= on + q - p and (not ago or back[zero - p] >= ago) for p in shorter):
            found.append((q, ago, on))
    return found


def solve(scale: int, first: int, bounds: list[int], ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, lo, hi) of all fragments of some neighbouring tiles, joined where they meet."""
    step, found = 2 * scale, []
    reached: dict[int, list[int]] = {}
    for bound in bounds:
        low = max(0, bound - step)
        tile = ids[low - first : bound + 2 * step - first]
        words = tile.tolist() if len(tile) < OBJECTS else array("i", tile.astype(np.int32).tobytes())
        for q, ago, on in fragments(scale, bound - low, words):
            lo, hi = bound - ago, bound + on
            if q in reached and lo <= reached[q][1]:
                reached[q][1] = max(hi, reached[q][1])
            else:
                if q in reached:
                    found.append((q, *reached[q]))
                reached[q] = [lo, hi]
    return found + [(q, *r) for q, r in reached.items()]


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for t in batch.itertuples(index=False):
            words = np.frombuffer(t.words, np.int32)
            rows += [(t.key, *f) for f in solve(t.scale, t.first, list(t.bounds), words)]
        yield pd.DataFrame(rows, columns=["key", "period", "lo", "hi"])


# ---- stitching ------------------------------------------------------------


def _stitched(found: DataFrame) -> DataFrame:
    """(key, start, period, length): the runs that the fragments make up."""
    place = Window.partitionBy("key", "period").orderBy("lo", "hi")
    reached = F.max("hi").over(place.rowsBetween(Window.unboundedPreceding, -1))
    apart = found.distinct().withColumn(
        "apart", F.coalesce(F.col("lo") > reached, F.lit(True)).cast("long")
    )
    joined = (
        apart.withColumn("piece", F.sum("apart").over(place))
        .groupBy("key", "period", "piece")
        .agg(F.min("lo").alias("start"), F.max("hi").alias("hi"))
    )
    length = F.col("hi") - F.col("start") + F.col("period")
    runs = joined.select("key", "start", "period", length.alias("length"))
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_TIMES * F.col("period")))


def _keyed(docs: DataFrame) -> Column:
    """What the runs of a row depend on, apart for different documents."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))


def runs(docs: DataFrame) -> DataFrame:
    """(key, start, period, length): all runs of all texts of docs (doc_id, text)."""
    texts = docs.select(_keyed(docs).alias("key"), "text")
    dealt = texts.mapInPandas(_tiles, TILES).repartition(
        partitions(docs.sparkSession), "key", "scale", "first"
    )
    return _stitched(dealt.mapInPandas(_solved, FRAGMENT))


@F.pandas_udf(StringType())
def _collapsed(texts: pd.Series, found: pd.Series) -> pd.Series:
    out = []
    for text, runs_ in zip(texts, found, strict=True):
        words = words_of(text)
        if runs_ is not None and len(runs_):
            kept = np.ones(len(words), bool)
            for start, period, length in runs_:
                kept[start + period : start + length] = False
            words = [words[i] for i in np.flatnonzero(kept)]
        out.append(b" ".join(words).decode())
    return pd.Series(out, dtype="object")


def with_runs(docs: DataFrame, into: str = "found") -> DataFrame:
    """docs and a struct column ``into``: the text's runs by start and period, and ``collapsed``,
    its words without those behind the first period of a run, joined by one space."""
    key = free_name(docs, "_run_key")
    by_text = (
        runs(docs)
        .groupBy(F.col("key").alias(key))
        .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias(into))
    )
    keyed = docs.withColumn(key, _keyed(docs))
    if into in docs.columns:
        raise ValueError(f"docs has a column {into!r} already")
    listed = F.coalesce(F.col(into), F.array().cast(RUNS))
    numbers = F.transform(into, lambda r: F.array(r["start"], r["period"], r["length"]))
    both = F.struct(listed.alias("runs"), _collapsed(F.col("text"), numbers).alias("collapsed"))
    return keyed.join(by_text, key, "left").withColumn(into, both).drop(key)


# ---- planted runs and digests, as the registered query wants them ----------


@F.pandas_udf(StringType())
def _planted(texts: pd.Series, digests: pd.Series) -> pd.Series:
    out = []
    for text, digest in zip(texts, digests, strict=True):
        words = words_of(text)
        if not words:
            out.append(text)
            continue
        n, g = len(words), int(digest) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        times = -(-(n - a) // p)
        out.append(b" ".join(words[:a] + (words[a : a + p] * times)[: n - a]).decode())
    return pd.Series(out, dtype="object")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by the checksum of its id, repeats some of its words
    from a place on up to its end."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(digest % 10 == 0, F.lit(False))
    changed = _planted(F.when(chosen, F.col("text")), F.coalesce(digest, F.lit(0)))
    return docs.select("doc_id", F.when(chosen, changed).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row of docs the number of its runs, that with the greatest length for its period, and
    digests of all runs and of the collapsed text."""
    found = F.col("found.runs")
    better = lambda a, x: x["length"] * a["period"] > a["length"] * x["period"]
    # Runs come by start and period, so of equal ones the first stays.
    best = F.reduce(found, F.get(found, F.lit(0)), lambda a, x: F.when(better(a, x), x).otherwise(a))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = with_runs(docs.select("doc_id", "text"))
    return rows.select("doc_id", "found", best.alias("best")).select(
        "doc_id",
        F.size(found).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(found, line), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed"), 256).alias("collapsed_sha256"),
    )

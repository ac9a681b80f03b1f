"""Phrase collocation mining by top-order marginalisation.

Texts are lower-cased (A-Z), split at punctuation and line ends into pieces, and equal pieces
of a language are kept once with their number. Columns that look ahead in a piece make of each
word the longest window that starts there, five words or, padded, fewer; only these windows are
counted. Their ROLLUP sums the counts of ever shorter prefixes, which are the counts of all
shorter phrases, so no other n-grams are made.

A window is padded from where two or three words follow that are too rare to be part of a
candidate. That leaves all counts of candidates as they are, and most windows, which are rare,
out of the count. Which those are is told by counts of hashes of two, and of frequent ones of
these, three words: words that share a hash are at least as rare as it says, so none are left
out that are frequent, and what is counted in the end are the words themselves.

Defined results: a null or empty text has no words; a null language is ``und``. Rows are
counted as often as they are there, whatever their ids. Ties of the score go by count, then by
the phrase in UTF-8 byte order. Empty tables give no rows. Only text and lang are read of a
table, so its other columns can have any name. A very long text, and then each of its pieces,
is held by one task while it is split.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivals_engine.llm.common import Scratch

# The characters at which pieces end; words are separated by blanks and tabs.
PIECE_END = b".,;:!?\n\x0b\x0c\r"
_TO_LINES = bytes.maketrans(PIECE_END, b"\n" * len(PIECE_END))

UNKNOWN = "und"
PAD = ""
ORDER = 5
EXACT = "decimal(38,0)"
#: So many bits of a hash are counted: fewer bytes to shuffle, and still few words to one hash.
HASH_BITS = 40


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different pieces of a batch, each with its language and number."""
    for batch in batches:
        found: Counter[tuple[str, bytes]] = Counter()
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for lang, text in zip(batch["lang"].to_pylist(), texts, strict=True):
            # lower() of bytes is that of A-Z, and split() takes the blanks and tabs left
            for line in (text or b"").lower().translate(_TO_LINES).split(b"\n"):
                words = line.split()
                if words:
                    found[lang, b" ".join(words)] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([piece for _, piece in found], pa.binary()).cast(pa.string()),
                pa.array(found.values(), pa.int64()),
            ],
            ["lang", "piece", "m"],
        )


def piece_counts(docs: DataFrame) -> DataFrame:
    """(lang, piece, m): every different piece of a language, its words joined by one space,
    and how often it is there. Frequent lines and passages become one row here."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    found = texts.mapInArrow(_pieces, "lang string, piece string, m long")
    return found.groupBy("lang", "piece").agg(F.sum("m").alias("m"))


WINDOW = [f"w{k}" for k in range(1, ORDER + 1)]


def _ahead(pieces: DataFrame) -> DataFrame:
    """Every word of a piece that is not its last, with the words after it, null behind the end."""
    after = [F.get("words", F.col("pos") + k).alias(f"w{k + 1}") for k in range(1, ORDER)]
    return (
        pieces.select("lang", "m", F.split("piece", " ").alias("words"))
        .select("lang", "m", "words", F.posexplode("words").alias("pos", "w1"))
        .select("lang", "m", "w1", *after)
        .where(F.col("w2").isNotNull())
    )


def _hash(first: int, size: int) -> Column:
    """Of so many words of a window from the first on, counted from 1, and their language."""
    words = WINDOW[first - 1 : first - 1 + size]
    return F.xxhash64("lang", *words).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _word_counts(pieces: DataFrame) -> DataFrame:
    words = pieces.select("lang", "m", F.explode(F.split("piece", " ")).alias("w1"))
    return words.groupBy("lang", "w1").agg(F.sum("m").alias("f"))


@dataclass(frozen=True)
class Hot:
    """Hashes (hash, f) with as many occurrences as a candidate needs, their number and the sum
    of their occurrences."""

    rows: DataFrame
    n: int
    total: int

    def mark(self, rows: DataFrame, key: str, most: int) -> DataFrame:
        """rows with a column ``<key>_hot``, true or null. Up to ``most`` hashes are broadcast.
        Beyond that only the most frequent ones are, each of which has at least one ``most``-th
        of all occurrences, so there are no more than ``most``; the others are merged, and none
        of them has more than such a part of the rows."""
        flag = f"{key}_hot"
        known = self.rows.select(F.col("hash").alias(key), "f", F.lit(True).alias(flag))
        if self.n <= most:
            return rows.join(F.broadcast(known.drop("f")), key, "left")
        heavy = known.where(F.col("f") * most >= F.lit(self.total)).drop("f")
        marked = rows.join(F.broadcast(heavy), key, "left")
        rest = marked.where(F.col(flag).isNull()).drop(flag)
        return marked.where(flag).unionByName(rest.join(known.drop("f").hint("merge"), key, "left"))


def _hot(rows: DataFrame, hashed: Column, least: int, scratch: Scratch, name: str) -> Hot:
    counted = rows.groupBy(hashed.alias("hash")).agg(F.sum("m").alias("f"))
    kept = scratch.put(counted.where(F.col("f") >= least), name)
    n, total = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("f"), F.lit(0))).first()
    return Hot(kept, n, total)


def _windows(pieces: DataFrame, least: int, scratch: Scratch, most: int) -> DataFrame:
    """(lang, w1 .. w5, f): the windows of all words, padded behind the last frequent words."""
    twos = _hot(_ahead(pieces), _hash(1, 2), least, scratch, "twos")
    begun = twos.mark(_ahead(pieces).withColumn("two", _hash(1, 2)), "two", most).where("two_hot")
    more = begun.where(F.col("w3").isNotNull()).withColumn("next", _hash(2, 2))
    more = twos.mark(more, "next", most).where("next_hot")
    threes = _hot(more, _hash(1, 3), least, scratch, "threes")
    windows = begun
    for k in range(3, ORDER + 1):
        # Behind the end of a piece the hash is that of fewer words, and the word stays null.
        windows = threes.mark(windows.withColumn(f"h{k}", _hash(k - 2, 3)), f"h{k}", most)
        told = F.col(f"h{k}_hot") & (F.lit(True) if k == 3 else F.col(f"kept{k - 1}") != PAD)
        word = F.coalesce(F.when(told, F.col(f"w{k}")), F.lit(PAD))
        windows = windows.withColumn(f"kept{k}", word)
    kept = [F.col(f"kept{k}").alias(f"w{k}") for k in range(3, ORDER + 1)]
    return windows.groupBy("lang", "w1", "w2", *kept).agg(F.sum("m").alias("f"))


def _marginals(windows: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f): all phrases of two to five words with f >= least."""
    head = F.struct("lang", "w1", "w2").alias("head")
    tail = [f"w{k}" for k in range(3, ORDER + 1)]
    summed = (
        windows.select(head, *tail, "f").rollup("head", *tail).agg(F.sum("f").alias("f"))
    ).where(F.col("head").isNotNull() & (F.col("f") >= least))
    # A null is a word that is summed over. A phrase ends before it, and must not end in PAD.
    there = [F.col(w).isNotNull() for w in tail]
    size = reduce(lambda n, x: n + x.cast("int"), there, F.lit(2))
    padded = reduce(lambda p, w: p | F.coalesce(F.col(w) == PAD, F.lit(False)), tail, F.lit(False))
    return summed.where(~padded).select(
        F.col("head.lang").alias("lang"),
        F.concat_ws(" ", "head.w1", "head.w2", *tail).alias("phrase"),
        size.alias("size"),
        "f",
    )


def _part(first: int | Column, length: int | Column) -> Column:
    """So many words of the phrase from the first on, counted from 1."""
    words = F.slice(F.split("phrase", " "), F.lit(first), F.lit(length))
    return F.array_join(words, " ")


def _covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, cover): the count of the most frequent longer phrase around a phrase."""
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: _part(i, n)
            ),
        )
    )
    return (
        phrases.where(F.col("size") > 2)
        .select("lang", F.explode(inner).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("cover"))
    )


def _scored(phrases: DataFrame, counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each phrase with the parts and score of its weakest cut. counts: (lang, phrase, f)."""
    cuts = phrases.select(
        "lang", "phrase", "size", "f", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "k",
        _part(1, F.col("k")).alias("first"),
        _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(sizes, "lang")

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(18,0)")

    above = (exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)")).cast(EXACT)
    score = F.call_function("div", above, (exact("l") * exact("r")).cast(EXACT))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(best).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def collocations(
    docs: DataFrame,
    *,
    min_count: int = 100,
    top: int | None = 2000,
    most_broadcast: int = 500_000,
    salts: int = 64,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of two to five words that are there
    at least ``min_count`` times and not merely part of an equally frequent longer one, by
    score; the first ``top`` of each language, or all."""
    scratch = Scratch(docs.sparkSession, "phrases")
    pieces = scratch.put(piece_counts(docs.select("lang", "text")), "pieces")
    words = scratch.put(_word_counts(pieces), "words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))  # a row per language
    frequent = scratch.put(words.where(F.col("f") >= min_count), "frequent")

    windows = scratch.put(_windows(pieces, min_count, scratch, most_broadcast), "windows")
    phrases = scratch.put(_marginals(windows, min_count), "phrases")
    counts = phrases.select("lang", "phrase", "f").unionByName(
        frequent.select("lang", F.col("w1").alias("phrase"), "f")
    )
    around = phrases.join(_covered(phrases), ["lang", "phrase"], "left")
    whole = around.where(F.col("cover").isNull() | (F.col("cover") < F.col("f")))
    scored = _scored(whole, counts, sizes)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:
        # Ranked in parts first, so that one language is not ranked by one task.
        salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
        part = Window.partitionBy("lang", "salt").orderBy(*order)
        scored = salted.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = scored.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    )
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Quality rules: counts per text, fixed base rules, and an isolation forest.

Each text gives a few counts (``RULES``). Base rules on them reject on their own. What
they leave is scored by an isolation forest on the shares derived from the counts: trees
of random splits, in which odd rows end early. The forest is fitted on a bounded sample
of labelled rows (``fit_rows``): the good ones and few bad ones (``bad_share``), which
stay rare enough to be odd and widen the range of the splits. Then the score from which a row is rejected is the one
that best separates the labels of that sample while rejecting at most ``max_good_lost``
of its good rows. Counting and scoring cover every row, in one pass without a shuffle.

Defined results: a null or empty text has no words and fails the base rules. Without
labelled rows of both kinds nothing but the base rules rejects. A document labelled more
than once counts as bad if any of its labels says so. Repeated rows are judged alike.
Other columns are kept, whatever their names. Very long texts are counted whole, one at a time;
an empty table gives no rows. Of repeated rows of a labelled id the sample has the one whose
text has the smallest digest, so the forest does not depend on the order of rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import WORD, free_name, then_release

RULES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines long"
)
VERDICT = RULES + ", base_failed boolean, score double, kept boolean"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_word = re.compile(WORD)


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three which the text holds at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    _, pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)
    windows = pairs[:-1] * len(ids) + codes[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    hit = counts[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in ``RULES``."""
    text = text or ""
    words = _word.findall(text)
    seen: set[str] = set()
    dup = filled = 0
    for line in text.split("\n"):
        if _word.search(line):
            filled += 1
            dup += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        dup,
        repeated_words(words),
        filled,
    )


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeats = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def shares(counts: np.ndarray) -> np.ndarray:
    """What the forest sees: mean word length, symbols a word and a character, and the share
    of repeated words and lines, whichever is larger."""
    c = counts.astype(float)
    words, chars, lines = (np.maximum(c[:, k], 1) for k in (0, 1, 5))
    repeats = np.maximum(c[:, 3] / lines, c[:, 4] / words)
    return np.column_stack([c[:, 1] / words, c[:, 2] / words, c[:, 2] / chars, repeats])


def mean_path(n: float) -> float:
    """Mean depth at which a search among n rows ends without a match."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass(frozen=True)
class Forest:
    """Trees as arrays with one row per tree. feature -1 marks a leaf, whose value is its depth."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    depth: int
    norm: float
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the odder a row, the higher."""
        total = np.zeros(len(rows))
        all_rows = np.arange(len(rows))
        for feature, value, left in zip(self.feature, self.value, self.left, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                inner = f >= 0
                right = rows[all_rows, np.maximum(f, 0)] >= value[at]
                at = np.where(inner, left[at] + right, at)
            total += value[at]
        return np.round(2.0 ** (-total / max(len(self.feature), 1) / self.norm), 9)


NO_FOREST = Forest(
    np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 0), int), 0, 1.0, math.inf
)


def _grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[list, list, list]:
    feature, value, left = [-1], [0.0], [0]
    todo = [(0, rows, 0)]
    while todo:
        node, here, depth = todo.pop()
        low, high = here.min(axis=0), here.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth == limit or not len(usable):
            value[node] = depth + mean_path(len(here))
            continue
        f = int(rng.choice(usable))
        cut = rng.uniform(low[f], high[f])
        cut = high[f] if cut <= low[f] else cut
        feature[node], value[node], left[node] = f, cut, len(feature)
        goes_right = here[:, f] >= cut
        for part in (here[~goes_right], here[goes_right]):
            todo.append((len(feature), part, depth + 1))
            feature.append(-1), value.append(0.0), left.append(0)
    return feature, value, left


def grow_forest(rows: np.ndarray, trees: int, tree_rows: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    grown = [_grow(rows[rng.choice(len(rows), size, replace=False)], rng, depth) for _ in range(trees)]
    width = max(len(t[0]) for t in grown)
    pad = lambda k, fill: np.array([t[k] + [fill] * (width - len(t[k])) for t in grown])
    return Forest(pad(0, -1), pad(1, 0.0), pad(2, 0), depth, max(mean_path(size), 1e-9), math.inf)


def calibrated(scores: np.ndarray, good: np.ndarray, max_good_lost: float) -> float:
    """The score from which to reject: most bad rows less good rows (as shares), among the
    cuts that lose at most that share of the good ones. Infinite if no cut is of use."""
    if not good.any() or good.all():
        return math.inf
    best, cut = 0.0, math.inf
    for s in np.unique(scores):
        lost = (scores[good] >= s).mean()
        gain = (scores[~good] >= s).mean() - lost
        if lost <= max_good_lost and gain > best:
            best, cut = gain, float(s)
    return cut


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    fit_rows: int = 8192,
    trees: int = 100,
    tree_rows: int = 256,
    max_good_lost: float = 0.0005,
    bad_share: float = 0.01,
    seed: int = 42,
) -> Forest:
    """A forest and its threshold from at most ``fit_rows`` labelled documents, those with
    the smallest hash of their id. Only this sample reaches the driver."""
    asked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(asked), "doc_id")  # fit_rows rows at most
        .select("doc_id", "good", F.md5("text").alias("digest"), _counts_udf()("text").alias("c"))
        .groupBy("doc_id")  # of repeated rows always the same one
        .agg(F.min_by(F.struct("good", "c"), F.coalesce("digest", F.lit(""))).alias("row"))
        .orderBy("doc_id")
        .select("row.good", "row.c.*")
        .limit(fit_rows)
        .toPandas()
    )
    counts = rows.drop(columns="good").to_numpy(np.int64)
    judged = ~base_failed(counts) if len(counts) else np.zeros(0, bool)
    if not judged.any():
        return NO_FOREST
    x, good = shares(counts)[judged], rows["good"].to_numpy()[judged] > 0
    few_bad = x[~good][: max(1, round(bad_share * good.sum()))]
    forest = grow_forest(np.concatenate([x[good], few_bad]), trees, tree_rows, seed)
    cut = calibrated(forest.scores(x), good, max_good_lost)
    return Forest(forest.feature, forest.value, forest.left, forest.depth, forest.norm, cut)


def _counts_frame(texts: pd.Series) -> pd.DataFrame:
    names = [c.split()[0] for c in RULES.split(", ")]
    return pd.DataFrame([text_counts(t) for t in texts], columns=names, dtype=np.int64)


def _counts_udf():
    @F.pandas_udf(RULES)
    @then_release
    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield _counts_frame(batch)

    return counts


def with_verdict(docs: DataFrame, forest: Forest, into: str = "quality") -> DataFrame:
    """docs and one struct column ``into`` of ``VERDICT``."""

    @F.pandas_udf(VERDICT)
    @then_release
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            frame = _counts_frame(batch)
            counts = frame.to_numpy(np.int64).reshape(-1, 6)
            frame["base_failed"] = base_failed(counts)
            frame["score"] = forest.scores(shares(counts))
            frame["kept"] = ~frame["base_failed"] & (frame["score"] < forest.threshold)
            yield frame

    return docs.withColumn(into, judge(F.col("text")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that neither the base rules nor the forest reject."""
    into = free_name(docs, "_quality_verdict")
    judged = with_verdict(docs, fit(docs, labels), into)
    return judged.where(F.col(into)["kept"]).drop(into)


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: its counts and whether it is kept."""
    judged = with_verdict(docs.select("doc_id", "text"), fit(docs, labels), "q")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id", *(F.col("q")[n].alias(n) for n in [*names, "base_failed", "kept", "score"])
    )

"""Language identification: known words first, then shorter and shorter character n-grams.

A word that the model knows counts with its log frequency in each language. A word that it
does not know falls back to its character n-grams of the longest length of which it knows
any, then to the next shorter ones. The language with the largest sum wins, ties going to
the first by name; the score is its posterior for equal priors.

The classifier is fitted on a bounded sample of labelled rows: of each language about
``fit_rows`` with the smallest hashes of their id (all of a language that has fewer), of every
language. Each language has the same share of ``max_words`` and ``max_grams`` for its own most
frequent words and n-grams, one at least, so the model's size has a bound for so many languages;
it is sent to all tasks. Counts are scaled to the same total for each language before they are
smoothed, so what no language knows prefers none.
Prediction covers every row in one pass without a shuffle.

Words are runs of letters (with marks and apostrophes inside), lower-cased. Defined results:
a null text, and one without a letter, is ``und`` with score 0; so is every text if nothing
was learned. Repeated rows are predicted alike. Only the text is used for a prediction, of a very
long text all of it. Ties go to the language that sorts first; no documents give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
GRAMS = (4, 3, 2, 1)
_word = regex.compile(r"\p{L}[\p{L}\p{M}'’]*")
_STRINGS = "array<string>"
_CACHE = 100_000


@dataclass(frozen=True)
class Model:
    """Log frequencies by language, in the order of langs."""

    langs: list[str]
    words: dict[str, np.ndarray]
    grams: dict[str, np.ndarray]
    unseen: np.ndarray

    def of_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        padded = f"\x02{word}\x03"
        for n in GRAMS:
            found = [
                v for k in range(len(padded) - n + 1) if (v := self.grams.get(padded[k : k + n])) is not None
            ]
            if found:
                return sum(found) / len(found)
        return self.unseen


class Predictor:
    """Predictions by one model; the sums of the tokens met last are kept."""

    def __init__(self, model: Model):
        self.model = model
        self.size = min(_CACHE, _CACHE * 20 // max(1, len(model.langs)))
        self.rows = np.zeros((self.size, len(model.langs)))
        self.row_of: dict[str, int] = {}

    def _row(self, token: str) -> int:
        """The row with the sum of the words in a token; row 0 for one without a word."""
        at = self.row_of.get(token)
        if at is None:
            words = _word.findall(token)
            at = len(self.row_of) + 1 if words else 0
            if words:
                self.rows[at] = sum(map(self.model.of_word, words))
            self.row_of[token] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter((text or "").lower().split())
        if not self.model.langs:
            return UNKNOWN, 0.0
        total, lettered = np.zeros(len(self.model.langs)), False
        tokens = list(counts)
        for k in range(0, len(tokens), self.size // 4):
            part = tokens[k : k + self.size // 4]
            if len(self.row_of) + len(part) + 1 > self.size:
                self.row_of.clear()
            at = np.fromiter(map(self._row, part), np.int64, len(part))
            n = np.fromiter((counts[t] for t in part), float, len(part))
            total += n @ self.rows[at]
            lettered = lettered or bool(at.any())
        if not lettered:
            return UNKNOWN, 0.0
        total = np.round(total, 6)
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def _words_udf():
    @F.pandas_udf(_STRINGS)
    def words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_word.findall((t or "").lower()) for t in texts])

    return words


def _sample(labelled: DataFrame, fit_rows: int) -> tuple[DataFrame, list[str]]:
    sizes = labelled.groupBy("lang").count().collect()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) / float(2**32)
    spark = labelled.sparkSession
    shares = spark.createDataFrame(
        [(lang, min(1.0, fit_rows / n)) for lang, n in sizes], "lang string, share double"
    )
    # A row for each language.
    rows = labelled.join(F.broadcast(shares), "lang").where(place < F.col("share"))
    return rows.select("lang", "text"), sorted(r["lang"] for r in sizes)


def _top_counts(rows: DataFrame, what: str, langs: list[str], most: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The most frequent values of ``what`` of each language, their counts in all languages,
    and all counts of each language."""
    counted = rows.groupBy("lang", what).agg(F.sum("n").alias("n"))
    by_lang = Window.partitionBy("lang")
    # The sample bounds what a language has.
    placed = counted.select(
        "lang",
        what,
        "n",
        F.row_number().over(by_lang.orderBy(F.desc("n"), what)).alias("place"),
        F.sum("n").over(by_lang).alias("total"),
    )
    each = max(1, most // len(langs))
    kept = (
        placed.groupBy(what)
        .agg(F.min("place").alias("place"), F.collect_list(F.struct("lang", "n", "total")).alias("counts"))
        .where(F.col("place") <= each)
        .orderBy(what)
        .select(what, "counts")
        .toPandas()
    )
    column = {lang: k for k, lang in enumerate(langs)}
    numbers, totals = np.zeros((len(kept), len(langs))), np.ones(len(langs))
    for row, counts in enumerate(kept["counts"]):
        for x in counts:
            numbers[row, column[x["lang"]]] = x["n"]
            totals[column[x["lang"]]] = x["total"]
    return list(kept[what]), numbers, totals


def _log_shares(
    values: list[str], numbers: np.ndarray, totals: np.ndarray
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    same = totals.mean()
    total = same + 0.5 * (len(values) + 1)
    logs = np.log((numbers * (same / totals) + 0.5) / total)
    return dict(zip(values, logs, strict=True)), np.full(len(totals), np.log(0.5 / total))


def fit(
    labelled: DataFrame,
    *,
    fit_rows: int = 4000,
    max_words: int = 100_000,
    max_grams: int = 100_000,
) -> Model:
    """A model from (doc_id, text, lang), rows without text or lang being left out."""
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample, langs = _sample(rows, fit_rows)
    if not langs:
        return Model([], {}, {}, np.zeros(0))
    counted = (
        sample.select("lang", F.explode_outer(_words_udf()("text")).alias("word"))
        .where(F.col("word").isNotNull())
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    words = _top_counts(counted, "word", langs, max_words)

    @F.pandas_udf(_STRINGS)
    def grams_of(values: pd.Series) -> pd.Series:
        padded = [f"\x02{w}\x03" for w in values]
        return pd.Series([[p[k : k + n] for n in GRAMS for k in range(len(p) - n + 1)] for p in padded])

    grams = _top_counts(
        counted.select("lang", "n", F.explode_outer(grams_of("word")).alias("gram")), "gram", langs, max_grams
    )
    by_word, _ = _log_shares(*words)
    by_gram, unseen = _log_shares(*grams)
    return Model(langs, by_word, by_gram, unseen)


def with_language(docs: DataFrame, model: Model, into: str = "language") -> DataFrame:
    """docs and one struct column ``into`` of lang_pred and score."""
    # Bounded by the limits of the model; as plain values, which need no import to be read.
    parts = (model.langs, model.words, model.grams, model.unseen)
    sent = docs.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = Predictor(Model(*sent.value))
        for texts in batches:
            yield pd.DataFrame(
                [predictor.predict(t) for t in texts], columns=["lang_pred", "score"]
            )

    return docs.withColumn(into, predict("text"))


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; no id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predictions(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from documents that are not held out."""
    held_out = is_held_out(F.col("doc_id"))
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang"), **how)
    rows = with_language(docs.select("doc_id", "text"), model, "p")
    return rows.select("doc_id", held_out.alias("held_out"), "p.lang_pred", "p.score")

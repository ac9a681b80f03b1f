"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. ``LineRuns``
keeps, for keys met so far, in how many documents they were met: each batch merge-anti-joins
the keys that are already known as frequent and adds a sorted run of the others. Runs of a
level are compacted into one of the next level as soon as there are ``fan_out`` of them;
keys that reach ``min_docs`` leave the levels for the frequent runs. A line goes if its key
is frequent. Runs are bucketed by key, so a batch shuffles its own keys and not the frequent
runs; a compaction shuffles the runs that it merges.

Each document must be in one batch only. Defined results: a null or empty text is one empty
line; keys shorter than ``min_chars`` never go. Rows with the same doc_id are one document;
without doc_id, rows of the same text are. Null texts stay null if nothing goes, and a
text of which all lines go becomes empty. Other columns are kept, whatever their names. A very
long text is split by one task, which holds its lines; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_engine.llm.common import UPPER, free_name, lower_ascii, partitions, row_identity, strip_space, then_release
from arrivals_engine.sources.scratch import scratch_path

KEPT = "text string, n_lines long, n_dropped long"
_SPACES = " \t\n\x0b\x0c\r"
_TO_LOWER = str.maketrans(UPPER, UPPER.lower())


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(lower_ascii(strip_space(line))))


def document_keys(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(doc, key), each key once per row of docs."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    long_enough = F.filter(lines, lambda x: F.char_length(strip_space(x)) >= min_chars)
    keys = F.array_distinct(F.transform(long_enough, line_key))
    # An inner explode would have the optimizer compute the array once more, in a filter.
    return docs.select(
        row_identity(F.col("doc_id"), F.col("text")).alias("doc"), F.explode_outer(keys).alias("key")
    ).where(F.col("key").isNotNull())


class LineRuns:
    """Runs of (key, n): in n documents of the batches added so far the key was met."""

    def __init__(self, spark: SparkSession, min_docs: int, fan_out: int = 2, most_frequent: int = 4):
        self.spark, self.min_docs = spark, min_docs
        self.fan_out, self.most_frequent = fan_out, most_frequent
        self.buckets = partitions(spark)
        self.levels: list[list[str]] = []
        self._frequent: list[tuple[DataFrame, str]] = []

    def _run(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """Written sorted, one file per bucket. The name in the catalogue goes at once; the
        files stay in the shared folder."""
        name, path = f"line_run_{uuid4().hex}", scratch_path(self.spark, "line_run")
        (
            rows.repartition(self.buckets, "key")
            .write.bucketBy(self.buckets, "key")
            .sortBy("key")
            .option("path", path)
            .saveAsTable(name)
        )
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return run, path

    def _rows(self, paths: list[str], schema: str = "key binary, n long") -> DataFrame:
        """Several runs as plain files: a union of bucketed scans passes for bucketed, but
        its parts of a bucket are not read by the same task."""
        return self.spark.read.schema(schema).parquet(*paths)

    def add(self, keys: DataFrame) -> None:
        """Adds a batch of (doc, key)."""
        counts = keys.distinct().groupBy("key").agg(F.count("*").alias("n"))
        for known, _ in self._frequent:
            counts = counts.join(known.hint("merge"), "key", "left_anti")
        self._put(0, self._run(counts)[1])

    def _put(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_out:
            runs, self.levels[level] = self.levels[level], []
            self._compact(runs, level + 1)

    def _compact(self, runs: list[str], to: int | None) -> None:
        merged = self._rows(runs).groupBy("key").agg(F.sum("n").alias("n"))
        self._frequent.append(self._run(merged.where(F.col("n") >= self.min_docs).select("key")))
        if len(self._frequent) > self.most_frequent:
            self._frequent = [self._run(self._all_frequent())]
        if to is not None:
            self._put(to, self._run(merged.where(F.col("n") < self.min_docs))[1])

    def _all_frequent(self) -> DataFrame:
        return self._rows([path for _, path in self._frequent], "key binary")

    def frequent(self) -> DataFrame:
        """The keys met in at least min_docs documents, after compacting all levels."""
        left = [run for level in self.levels for run in level]
        if left:
            self._compact(left, None)
            self.levels = []
        return self._all_frequent()


@then_release
def _without_lines(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, drops in batches:
        out = []
        for text, drop in zip(texts, drops, strict=True):
            lines = (text or "").split("\n")
            kept = text
            n = 0
            if drop is not None and len(drop):
                gone = {bytes(k) for k in drop}
                left = [
                    x
                    for x in lines
                    if hashlib.md5(x.strip(_SPACES).translate(_TO_LOWER).encode()).digest()
                    not in gone
                ]
                n, kept = len(lines) - len(left), "\n".join(left)
            out.append((kept, len(lines), n))
        yield pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def without_frequent_lines(
    docs: DataFrame,
    *,
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    most_broadcast: int = 1_000_000,
    into: str = "kept",
) -> DataFrame:
    """docs and one struct column ``into`` of ``KEPT``. The corpus is added to the runs in so
    many batches; every batch holds its documents whole. Up to ``most_broadcast`` frequent keys
    are broadcast to those of the documents, so that a key that a third of the documents has
    meets in no task; with more of them they are merged."""
    spark = docs.sparkSession
    path = scratch_path(spark, "line_keys")
    (
        document_keys(docs, min_chars)
        .withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))
        .write.partitionBy("batch")
        .parquet(path)
    )
    keys = spark.read.schema("doc string, key binary, batch int").parquet(path)
    runs = LineRuns(spark, min_docs)
    for batch in range(batches):
        runs.add(keys.where(F.col("batch") == batch).select("doc", "key"))
    doc, drop = free_name(docs, "_line_doc"), free_name(docs, "_line_drop")
    frequent = runs.frequent()
    small = frequent.count() <= most_broadcast
    drops = (
        keys.join(F.broadcast(frequent) if small else frequent, "key", "left_semi")
        .groupBy(F.col("doc").alias(doc))
        .agg(F.collect_set("key").alias(drop))  # as many as the document has lines at most
    )
    return (
        docs.withColumn(doc, row_identity(F.col("doc_id"), F.col("text")))
        .join(drops, doc, "left")
        .withColumn(into, F.pandas_udf(_without_lines, KEPT)(F.col("text"), F.col(drop)))
        .drop(doc, drop)
    )


def drop_frequent_lines(docs: DataFrame, **how) -> DataFrame:
    """docs with the text, and n_chars if there is one, of what stays."""
    into = free_name(docs, "_line_kept")
    rows = without_frequent_lines(docs, into=into, **how)
    changed = {"text": F.col(into)["text"]}
    if "n_chars" in docs.columns:
        gone = F.col(into)["n_dropped"] > 0
        length = F.char_length(F.col(into)["text"]).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(gone, length).otherwise(F.col("n_chars"))
    return rows.withColumns(changed).drop(into)


def line_digests(docs: DataFrame, **how) -> DataFrame:
    """Per row of docs how many lines it has and loses, and the digest of what stays."""
    kept = F.col("kept")
    return without_frequent_lines(docs.select("doc_id", "text"), **how).select(
        "doc_id",
        kept["n_lines"].alias("n_lines"),
        kept["n_dropped"].alias("n_dropped"),
        F.sha2(F.coalesce(kept["text"], F.lit("")), 256).alias("kept_sha256"),
    )

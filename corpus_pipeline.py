"""A training corpus from raw documents, in stages that each work on what the last one kept.

Defined results: null and empty texts fail the base rules of the first stage. Repeated rows are
judged alike and count as one document, also for lines; near copies leave the row with the
smallest id, with all its repetitions, or one row where none has an id. Very long texts go
through whole. Other columns are kept, whatever their names, up to the last stage, which returns
doc_id, n_tokens, ids_sha256 and decoded_sha256. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arrivals_engine.llm import bpe, decontaminate, lines, quality, shingles
from arrivals_engine.llm.common import Scratch, table, with_small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the forest reject go."""
    with_small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least ten documents have go from all of them; the documents stay."""
    with_small_batches(spark)
    return lines.drop_frequent_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, that with the smallest id."""
    with_small_batches(spark)
    return shingles.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number and digest of its ids and the digest of their decoding."""
    with_small_batches(spark)
    return bpe.token_digests(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: An isolation forest and a vocabulary's merges are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage but the last is written and read again, so a
    lost executor costs no more than the stage it worked on."""
    scratch = Scratch(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage_{k}")
        if k:
            scratch.drop(f"stage_{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Helpers that several of these operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_engine.sources.scratch import scratch_path

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def strip_space(text: Column) -> Column:
    """Without ASCII white space at both ends."""
    return F.trim(text, F.lit(" \t\n\x0b\x0c\r"))


def row_identity(doc_id: Column, text: Column) -> Column:
    """What makes two rows the same document: the id, or the text where there is none."""
    return F.coalesce(
        F.concat(F.lit("i"), doc_id.cast("string")),
        F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))),
    )


def free_name(docs: DataFrame, name: str) -> str:
    """The name, longer if docs has a column that is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


class Scratch:
    """Tables in the shared scratch folder: written once and read back, which cuts the lineage
    without depending on any executor staying alive. Dropped ones free their space."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, scratch_path(spark, label)

    def put(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        """For tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            conf = self.spark.sparkContext._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


def with_small_batches(spark: SparkSession, size: str = "16m") -> None:
    """Bounds what a Python worker holds at a time, for this session. Spark's own bound is four
    times as large, too much for small executors whose workers hold a batch several times."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def then_release(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """The same function of batches, which gives memory back when a task is done. Python workers
    live on from task to task and stage to stage, and what one has freed but kept counts
    against the executor when the next stage's workers and the JVM need it."""

    @wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

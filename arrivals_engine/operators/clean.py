"""Typing, deduplication and defaults of raw arrival records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_engine.functions.categories import NOT_REPORTED
from arrivals_engine.schemas import ARRIVAL_COLUMNS
from arrivals_engine.sources.scratch import scratch_path

# The defaults of missing fields.
UNKNOWN_NUMBER = -1
UNKNOWN_DAY = 0


_TYPES = {name: (raw, typed) for name, raw, typed in ARRIVAL_COLUMNS}


def typed_arrival(name: str) -> Column:
    """A raw column in its type, numbers narrowed towards zero; what does not fit is null. Raw
    numbers may also come as text."""
    raw, typed = _TYPES[name]
    return F.col(name).try_cast(raw).try_cast(typed)


def type_arrivals(raw: DataFrame) -> DataFrame:
    """The 15 used columns, typed."""
    return raw.select(*(typed_arrival(name).alias(name) for name in _TYPES))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Whole-row distinct, nulls equal. Copies collapse before the shuffle, so a
    row with very many copies costs one row per task."""
    return rows.dropDuplicates()


def distinct_rows_by_digest(rows: DataFrame, max_repeated: int = 1_000_000) -> DataFrame:
    """The same with less to shuffle where copies are rare: digests are counted first, rows whose
    digest is there once stay where they are, and only the others are compared as a whole. Rows
    of different values that share a digest are merely compared too.

    Rows are read three times. More than `max_repeated` repeated digests are not broadcast; then
    whole rows are shuffled as in distinct_rows.
    """
    name = "_digest"
    while name in rows.columns:
        name += "_"
    # A hash passes over nulls, so it is told which columns have one.
    nulls = F.concat(*(F.col(c).isNull().cast("string") for c in rows.columns))
    keyed = rows.withColumn(name, F.xxhash64(nulls, *rows.columns))
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "digests")
    counted = keyed.groupBy(name).agg(F.count(F.lit(1)).alias("copies"))
    counted.filter("copies > 1").select(name).write.parquet(path)
    repeated = spark.read.schema(f"`{name}` bigint").parquet(path)
    if repeated.count() > max_repeated:
        return distinct_rows(rows)
    again = F.broadcast(repeated)
    return (
        keyed.join(again, name, "left_anti")
        .unionByName(keyed.join(again, name, "left_semi").dropDuplicates())
        .drop(name)
    )


def with_id(rows: DataFrame) -> DataFrame:
    return rows.dropna(subset=["admnum"])


def fill_unknowns(rows: DataFrame) -> DataFrame:
    return (
        rows.fillna(UNKNOWN_NUMBER, subset=["i94bir", "biryear"])
        .fillna(UNKNOWN_DAY, subset=["arrdate", "depdate"])
        .fillna(NOT_REPORTED, subset=["visatype", "gender", "dtaddto"])
    )


def clean_arrivals(raw: DataFrame) -> DataFrame:
    """Rows without an id go first: the result is the same and they are not shuffled."""
    return fill_unknowns(distinct_rows(with_id(type_arrivals(raw))))

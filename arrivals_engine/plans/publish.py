"""Staging, gating and publishing: the monthly increment and the yearly refresh."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_engine import schemas
from arrivals_engine.functions.dates import month_of
from arrivals_engine.operators.decode import Lookups
from arrivals_engine.operators.quality import (
    ALL_CHECKS,
    PUBLISH_CHECKS,
    HeldMonths,
    LoadCounts,
    LoadWatch,
    QualityError,
    collision_report,
    gate,
    gate_batch,
    held_months,
    limit_rejected,
    union_all,
)
from arrivals_engine.plans import reports, star
from arrivals_engine.sources import tables
from arrivals_engine.sources.readers import read_typed_json


DEFAULT_BATCH = "load"


@dataclass(frozen=True)
class Batch:
    """The three arrival tables of one load. same_keys: fact and visitors are views of the
    same rows, so what holds for the keys of one holds for the other."""

    fact: DataFrame
    visitors: DataFrame
    arrival_date: DataFrame
    same_keys: bool = False

    def tables(self) -> list[tuple[DataFrame, schemas.Table]]:
        return [
            (self.fact, schemas.VISITOR_ANALYSIS),
            (self.visitors, schemas.VISITORS),
            (self.arrival_date, schemas.ARRIVAL_DATE),
        ]


def _batch_name(name: str) -> str:
    """Batch names are part of paths."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
        raise ValueError(f"a batch name is letters, digits, '_', '.' and '-', not {name!r}")
    return name


def staged_batch(spark: SparkSession, db: str, name: str = DEFAULT_BATCH) -> Batch:
    staged = spark.table(f"{db}.{schemas.STAGE_VISITS.name}")
    return batch_of(staged.filter(F.col("batch") == _batch_name(name)))


def stage_visits(
    spark: SparkSession,
    db: str,
    visits: DataFrame,
    single_month: bool = False,
    name: str = DEFAULT_BATCH,
) -> Batch:
    """Writes the batch once, replacing the one staged before under its name; fact, visitors
    and dates are then read from it instead of being worked out three times. Batches of other
    names stay, and may be staged at the same time.

    Rows are rebalanced by month, which splits a large month into files of even
    size and keeps small months from being scattered over many. A file with a
    single month needs no such shuffle.
    """
    if not single_month:
        visits = visits.hint("rebalance", "year_month")
    release(spark, db, name)
    rows = visits.withColumn("batch", F.lit(_batch_name(name)))
    # Files of a dynamic overwrite are prepared in a folder of their own.
    tables.replace_partitions(spark, rows, f"{db}.{schemas.STAGE_VISITS.name}")
    return staged_batch(spark, db, name)


def release(spark: SparkSession, db: str, name: str = DEFAULT_BATCH) -> None:
    """Takes a staged batch out of the stage."""
    tables.drop_partitions(spark, f"{db}.{schemas.STAGE_VISITS.name}", batch=[_batch_name(name)])


def staged_names(spark: SparkSession, db: str) -> list[str]:
    shown = spark.sql(f"SHOW PARTITIONS {db}.{schemas.STAGE_VISITS.name}").collect()
    return sorted(row[0].split("=", 1)[1] for row in shown)


def batch_of(visits: DataFrame) -> Batch:
    """The three tables of visits."""
    return Batch(
        star.visit_fact(visits), star.visitor_dim(visits), star.arrival_date_dim(visits), True
    )


def export_json(batch: Batch, directory: str) -> list[str]:
    """Fact, visitors and dates as JSON lines, one sub-directory each; returns them."""
    paths = []
    for rows, table in batch.tables():
        paths.append(f"{directory.rstrip('/')}/{table.name}")
        tables.write_json(rows, paths[-1])
    return paths


def json_batch(
    spark: SparkSession, fact_path: str, visitors_path: str, arrival_date_path: str
) -> Batch:
    """A batch that was handed over as three directories of JSON lines."""
    return Batch(
        read_typed_json(spark, fact_path, schemas.VISITOR_ANALYSIS),
        read_typed_json(spark, visitors_path, schemas.VISITORS),
        read_typed_json(spark, arrival_date_path, schemas.ARRIVAL_DATE),
    )


def _gate_months(batch: Batch) -> None:
    """Fact and visitors must hold the same months, as a month is replaced in both."""
    held = batch.fact.select("year_month").distinct()
    other = batch.visitors.select("year_month").distinct()
    odd = held.exceptAll(other).unionByName(other.exceptAll(held)).collect()
    if odd:
        raise QualityError(f"fact and visitors differ in months: {sorted(r[0] for r in odd)}")


def _gate_new_keys(
    spark: SparkSession, db: str, batch: Batch, mode: str, held: HeldMonths
) -> None:
    name = f"{db}.{schemas.VISIT_KEYS.name}"
    if batch.same_keys:
        arrival, own = map(set, (map(str, held.arrival), map(str, held.own)))
        if not any(
            p["arrival_month"] in arrival and (mode == "append" or p["year_month"] not in own)
            for p in tables.partitions(spark, name)
        ):
            return  # the index has no partition that could hold one of the keys
    index = spark.table(name)
    keyed = [(rows, table) for rows, table in batch.tables() if table.key == schemas.VISIT_KEY]

    def report(sample: int) -> DataFrame:
        return union_all(
            [
                collision_report(
                    rows,
                    index,
                    table,
                    mode == "replace",
                    sample,
                    held if table is schemas.VISITOR_ANALYSIS else None,
                )
                for rows, table in (keyed[:1] if batch.same_keys else keyed)
            ]
        )

    if not report(0).filter(~F.col("passed")).isEmpty():
        gate(report(5))


def _keys(batch: Batch) -> DataFrame:
    """The rows of the key index for a batch."""

    def of(rows: DataFrame, in_fact: bool, in_visitors: bool) -> DataFrame:
        return rows.select(
            *schemas.VISIT_KEY,
            F.lit(in_fact).alias(f"in_{schemas.VISITOR_ANALYSIS.name}"),
            F.lit(in_visitors).alias(f"in_{schemas.VISITORS.name}"),
            "year_month",
            month_of(F.col("arrival_date")).alias("arrival_month"),
        )

    if batch.same_keys:
        return of(batch.fact, True, True)
    both = of(batch.fact, True, False).unionByName(of(batch.visitors, False, True))
    flags = [c for c in both.columns if c.startswith("in_")]
    return both.groupBy(*(c for c in both.columns if c not in flags)).agg(
        *(F.bool_or(c).alias(c) for c in flags)
    )


def _put(spark: SparkSession, db: str, rows: DataFrame, table: schemas.Table, mode: str) -> None:
    buckets = tables.bucket_count(spark, db, table)
    if buckets:
        # One task per bucket; the key is unique by now, so the buckets are even.
        rows = rows.repartition(buckets, *table.key)
    put = tables.replace_partitions if mode == "replace" else tables.append_rows
    put(spark, rows, f"{db}.{table.name}")


def _put_keys(spark: SparkSession, db: str, batch: Batch, mode: str, held: HeldMonths) -> None:
    """New keys are there before those they take the place of go: a publish that is broken off
    leaves too many keys, not too few. Those are whole partitions of the index, so the list of
    these tells them."""
    keys = _keys(batch)
    _put(spark, db, keys, schemas.VISIT_KEYS, mode)
    if mode == "replace":
        name = f"{db}.{schemas.VISIT_KEYS.name}"
        months = {str(month) for month in held.own}
        now = held if batch.same_keys else held_months(keys)
        filled = {(str(month), str(arrival)) for month, arrival in now.pairs}
        gone = [
            p
            for p in tables.partitions(spark, name)
            if p["year_month"] in months and (p["year_month"], p["arrival_month"]) not in filled
        ]
        tables.drop_listed(spark, name, gone)


def _merge_counts(spark: SparkSession, db: str, fact: DataFrame, gone: list[int] | None) -> None:
    """Adds the counts of visits to those that are kept, without those of the months that are
    gone, or, if that is None, in place of all. They are a few rows a month, so both tables are
    written anew, each as one file."""
    visits = fact.groupBy("arrival_date", "year_month").agg(F.count(F.lit(1)).alias("visits"))
    new = {}
    for table, counted in (
        (schemas.DATE_VISITS, visits),
        (schemas.MONTH_COUNTS, reports.month_counts(fact)),
    ):
        *keys, number = table.names
        rows = counted.select(*table.names)
        if gone is not None:
            kept = spark.table(f"{db}.{table.name}").filter(~F.col("year_month").isin(gone))
            rows = rows.unionByName(kept)
        new[f"{db}.{table.name}"] = rows.groupBy(*keys).agg(F.sum(number).alias(number))
    tables.replace_whole(spark, new)


def _drop_dates_without_visits(spark: SparkSession, db: str) -> None:
    name = f"{db}.{schemas.ARRIVAL_DATE.name}"
    dates = spark.table(name)
    visited = spark.table(f"{db}.{schemas.DATE_VISITS.name}").select("arrival_date").distinct()
    if not dates.join(visited, "arrival_date", "left_anti").isEmpty():
        tables.replace_whole(spark, {name: dates.join(visited, "arrival_date", "left_semi")})


def publish_batch(
    spark: SparkSession,
    db: str,
    batch: Batch,
    mode: str = "replace",
    checks: tuple[str, ...] = PUBLISH_CHECKS,
) -> None:
    """Checks a batch as a whole and only then puts it into the final tables.

    'replace' swaps the year_month partitions of the batch, so publishing a month
    again changes nothing; the batch must then hold those months completely, and keys
    published under other months are refused. 'append' adds to its months and refuses
    all keys that are already there. Published rows are not read for that, only the index
    of their keys. The fact goes last, so that it never points to a missing visitor or date;
    then dates that no visit has any more leave the dimension.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode is 'replace' or 'append', not {mode!r}")
    gate_batch(batch.tables(), checks)
    if not batch.same_keys:
        _gate_months(batch)
    held = held_months(batch.fact)
    _gate_new_keys(spark, db, batch, mode, held)

    dates_name = f"{db}.{schemas.ARRIVAL_DATE.name}"
    known = spark.table(dates_name).select("arrival_date")
    tables.append_rows(
        spark, batch.arrival_date.join(known, "arrival_date", "left_anti"), dates_name
    )
    _put_keys(spark, db, batch, mode, held)
    _put(spark, db, batch.visitors, schemas.VISITORS, mode)
    _put(spark, db, batch.fact, schemas.VISITOR_ANALYSIS, mode)
    _merge_counts(spark, db, batch.fact, held.own if mode == "replace" else [])
    if mode == "replace":
        _drop_dates_without_visits(spark, db)


def rebuild_kept(spark: SparkSession, db: str) -> None:
    """The key index and the counts of dates and months anew from the published tables: for a warehouse of
    before they were kept, and after an append that was broken off."""
    fact = spark.table(f"{db}.{schemas.VISITOR_ANALYSIS.name}")
    batch = Batch(
        fact, spark.table(f"{db}.{schemas.VISITORS.name}"), spark.table(f"{db}.{schemas.ARRIVAL_DATE.name}")
    )
    tables.drop_partitions(spark, f"{db}.{schemas.VISIT_KEYS.name}")
    _put(spark, db, _keys(batch), schemas.VISIT_KEYS, "append")
    _merge_counts(spark, db, fact, None)


def publish_month(
    spark: SparkSession,
    db: str,
    raw: DataFrame,
    lookups: Lookups,
    mode: str = "replace",
    single_month: bool = False,
    max_rejected: int | None = None,
    name: str = DEFAULT_BATCH,
) -> LoadCounts:
    """From one file of arrival records to the final tables, through a staged batch of the given
    name. Says what became of the records, counted while they were staged. With
    `max_rejected`, a file with more values than that in a column that its type cannot hold
    is refused; it stays staged."""
    watch = LoadWatch()
    visits = watch.rows(star.build_visits(watch.raw(raw), lookups))
    batch = stage_visits(spark, db, visits, single_month, name)
    if max_rejected is not None:
        limit_rejected(watch, max_rejected)
    publish_batch(spark, db, batch, mode)
    return watch.counts()


def publish_json(
    spark: SparkSession,
    db: str,
    fact_path: str,
    visitors_path: str,
    arrival_date_path: str,
    mode: str = "replace",
) -> None:
    """From three directories of JSON lines to the final tables."""
    batch = json_batch(spark, fact_path, visitors_path, arrival_date_path)
    publish_batch(spark, db, batch, mode, ALL_CHECKS)


def refresh_demographics(
    spark: SparkSession, db: str, totals: DataFrame, races: DataFrame
) -> None:
    """Replaces both demographic tables, after the staged rows passed the checks."""
    staged = []
    for rows, stage, table in (
        (totals, schemas.STAGE_STATE_DEMOGRAPHICS, schemas.STATE_DEMOGRAPHICS),
        (races, schemas.STAGE_STATE_DEMOGRAPHICS_BY_RACE, schemas.STATE_DEMOGRAPHICS_BY_RACE),
    ):
        tables.replace_rows(spark, rows, f"{db}.{stage.name}")
        staged.append((spark.table(f"{db}.{stage.name}"), table))
    gate_batch(staged, ALL_CHECKS)
    (staged_totals, _), (staged_races, _) = staged
    tables.replace_whole(
        spark,
        {
            f"{db}.{schemas.STATE_DEMOGRAPHICS.name}": star.narrow_totals(staged_totals),
            f"{db}.{schemas.STATE_DEMOGRAPHICS_BY_RACE.name}": staged_races,
        },
    )


def refresh_demographics_json(
    spark: SparkSession, db: str, totals_path: str, races_path: str
) -> None:
    """Replaces both demographic tables from two directories of JSON lines."""
    refresh_demographics(
        spark,
        db,
        read_typed_json(spark, totals_path, schemas.STAGE_STATE_DEMOGRAPHICS),
        read_typed_json(spark, races_path, schemas.STAGE_STATE_DEMOGRAPHICS_BY_RACE),
    )

"""Command line of the load jobs, for spark-submit.

    create        make the tables, dropping those of before with --drop
    arrivals      one month's file to the final tables
    rebuild       key index and counts of dates from the final tables
    demographics  a directory of nested JSON to the final tables
    load-json     three directories of JSON lines to the final tables
    load-demographics-json  two directories of JSON lines to the final tables
    export-json   one month's file, or nested demographics, to JSON lines only

A failed check raises, so the job ends with an error status and the published
tables stay as they were.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from arrivals_engine import schemas
from arrivals_engine.operators.decode import Lookups, checked_lookups
from arrivals_engine.plans import publish, star
from arrivals_engine.sources import readers, tables


def read_lookups(spark: SparkSession, ports: str, destinations: str, origins: str) -> Lookups:
    return checked_lookups(
        readers.read_lookup(spark, ports, schemas.PORT_COLUMNS),
        readers.read_lookup(spark, destinations, schemas.DESTINATION_COLUMNS),
        readers.read_lookup(spark, origins, schemas.ORIGIN_COLUMNS),
    )


def create(spark: SparkSession, args: argparse.Namespace) -> None:
    location = f" LOCATION '{args.location}'" if args.location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.db}{location}")
    if args.drop:
        tables.drop_tables(spark, args.db)
    tables.create_tables(spark, args.db, args.buckets)


def arrivals(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = readers.read_arrivals(spark, args.file, args.format, as_text=args.format == "csv")
    lookups = read_lookups(spark, args.ports, args.destinations, args.origins)
    counts = publish.publish_month(
        spark,
        args.db,
        raw,
        lookups,
        args.mode,
        not args.several_months,
        args.max_rejected,
        args.batch,
    )
    for what, n in counts.lines():
        print(f"{what}: {n}")
    if args.json_out:
        publish.export_json(publish.staged_batch(spark, args.db, args.batch), args.json_out)
    if args.release:
        publish.release(spark, args.db, args.batch)


def rebuild(spark: SparkSession, args: argparse.Namespace) -> None:
    publish.rebuild_kept(spark, args.db)


def demographics(spark: SparkSession, args: argparse.Namespace) -> None:
    flat = star.flatten_demographics(readers.read_demographics(spark, args.directory))
    publish.refresh_demographics(
        spark, args.db, star.demographic_totals(flat), star.demographic_races(flat)
    )
    if args.json_out:
        for table in (schemas.STATE_DEMOGRAPHICS, schemas.STATE_DEMOGRAPHICS_BY_RACE):
            tables.write_json(
                spark.table(f"{args.db}.{table.name}"), f"{args.json_out}/{table.name}"
            )


def load_json(spark: SparkSession, args: argparse.Namespace) -> None:
    publish.publish_json(
        spark, args.db, args.fact, args.visitors, args.arrival_date, args.mode
    )


def load_demographics_json(spark: SparkSession, args: argparse.Namespace) -> None:
    publish.refresh_demographics_json(spark, args.db, args.totals, args.races)


def export_json(spark: SparkSession, args: argparse.Namespace) -> None:
    """Without a warehouse and without checks: a batch that is to be looked at."""
    if args.demographics:
        flat = star.flatten_demographics(readers.read_demographics(spark, args.demographics))
        for rows, table in (
            (star.narrow_totals(star.demographic_totals(flat)), schemas.STATE_DEMOGRAPHICS),
            (star.demographic_races(flat), schemas.STATE_DEMOGRAPHICS_BY_RACE),
        ):
            tables.write_json(rows, f"{args.out}/{table.name}")
    if args.file:
        raw = readers.read_arrivals(spark, args.file, args.format)
        visits = star.build_visits(
            raw, read_lookups(spark, args.ports, args.destinations, args.origins)
        )
        publish.export_json(publish.batch_of(visits), args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="arrivals_engine.jobs", description=__doc__)
    top.add_argument("--db", help="needed by all but export-json")
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("create")
    job.add_argument("--location")
    job.add_argument("--buckets", type=int)
    job.add_argument("--drop", action="store_true")
    job.set_defaults(run=create)

    job = jobs.add_parser("arrivals")
    job.add_argument("file")
    job.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    job.add_argument("--ports", required=True)
    job.add_argument("--destinations", required=True)
    job.add_argument("--origins", required=True)
    job.add_argument("--mode", default="replace", choices=("replace", "append"))
    job.add_argument("--several-months", action="store_true")
    job.add_argument("--max-rejected", type=int, help="refuse a file with more in a column")
    job.add_argument("--batch", default=publish.DEFAULT_BATCH, help="name in the stage")
    job.add_argument("--release", action="store_true", help="empty the stage afterwards")
    job.add_argument("--json-out")
    job.set_defaults(run=arrivals)

    job = jobs.add_parser("rebuild")
    job.set_defaults(run=rebuild)

    job = jobs.add_parser("demographics")
    job.add_argument("directory")
    job.add_argument("--json-out")
    job.set_defaults(run=demographics)

    job = jobs.add_parser("load-json")
    job.add_argument("fact")
    job.add_argument("visitors")
    job.add_argument("arrival_date")
    job.add_argument("--mode", default="replace", choices=("replace", "append"))
    job.set_defaults(run=load_json)

    job = jobs.add_parser("load-demographics-json")
    job.add_argument("totals")
    job.add_argument("races")
    job.set_defaults(run=load_demographics_json)

    job = jobs.add_parser("export-json")
    job.add_argument("out")
    job.add_argument("--file")
    job.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    job.add_argument("--ports")
    job.add_argument("--destinations")
    job.add_argument("--origins")
    job.add_argument("--demographics")
    job.set_defaults(run=export_json)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if args.run is not export_json and not args.db:
        raise SystemExit("--db is needed")
    args.run(spark or SparkSession.builder.appName("arrivals").getOrCreate(), args)


if __name__ == "__main__":
    main()

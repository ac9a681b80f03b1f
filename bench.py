"""Timings of the builders and reports; prints one JSON line.

Builders and reports are run from the raw tables as registered, and the reports
once more over published tables (names with a "star." prefix), which is how they
run day to day. Each is warmed up once; the median of three runs is kept. The
publish itself is timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_engine import catalogue, fixtures
from arrivals_engine.fixtures import Tables
from arrivals_engine.plans import publish, reports, star

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

FROM_RAW = (
    "visits",
    "visit_fact",
    "visitor_dim",
    "arrival_date_dim",
    "demographics_total",
    "demographics_race",
    "top_ports",
    "visits_by_month_gender",
    "top_ports_population",
    "visits_by_visa",
    "top_origins",
    "visits_by_month",
    "visits_by_mode",
    "port_diversity",
)


def publish_star(spark: SparkSession) -> str:
    t = Tables(spark, SF_DIR)
    db = catalogue.new_warehouse(spark)
    publish.publish_month(spark, db, fixtures.raw_arrivals(t), catalogue.lookups(t))
    flat = star.flatten_demographics(fixtures.raw_demographics(t))
    publish.refresh_demographics(
        spark, db, star.demographic_totals(flat), star.demographic_races(flat)
    )
    return db


def append_month(spark: SparkSession, db: str) -> float:
    """One more month to all that is published: its key check reads the dates it has only."""
    batch = publish.staged_batch(spark, db)
    new = [
        rows.filter("arrival_date >= '1998-01-01'").withColumn(
            "admission_id", F.col("admission_id") + 10**12
        )
        for rows in (batch.fact, batch.visitors)
    ]
    moved = publish.Batch(*new, batch.arrival_date, same_keys=True)
    start = time.perf_counter()
    publish.publish_batch(spark, db, moved, mode="append")
    return round(time.perf_counter() - start, 3)


def star_reports(spark: SparkSession, db: str) -> dict[str, Callable[[], DataFrame]]:
    def table(name: str) -> DataFrame:
        return spark.table(f"{db}.{name}")

    def fact() -> DataFrame:
        return table("visitor_analysis")

    def counts() -> DataFrame:
        return table("month_counts")

    def totals() -> DataFrame:
        return table("state_demographics")

    return {
        "top_ports": lambda: reports.top_ports(counts()),
        "visits_by_month_gender": lambda: reports.visits_by_month_gender(
            fact(), table("visitors"), table("arrival_date"), gated=True
        ),
        "top_ports_population": lambda: reports.top_ports_population(counts(), totals()),
        "visits_by_visa": lambda: reports.visits_by_visa(counts()),
        "top_origins": lambda: reports.top_origins(counts()),
        "visits_by_month": lambda: reports.visits_by_month(counts()),
        "visits_by_mode": lambda: reports.visits_by_mode(counts()),
        "port_diversity": lambda: reports.port_diversity(
            counts(), totals(), table("state_demographics_by_race")
        ),
    }


def seconds(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(make: Callable[[], DataFrame]) -> float:
    seconds(make)
    return round(statistics.median(seconds(make) for _ in range(RUNS)), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("arrivals-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    registered = catalogue.queries()
    seconds(lambda: registered["top_ports_population"](spark, SF_DIR))
    timings = {
        name: median(lambda query=registered[name]: query(spark, SF_DIR)) for name in FROM_RAW
    }
    start = time.perf_counter()
    db = publish_star(spark)
    timings["publish"] = round(time.perf_counter() - start, 3)
    timings["append_month"] = append_month(spark, db)
    for name, make in star_reports(spark, db).items():
        timings[f"star.{name}"] = median(make)

    print(
        json.dumps(
            {
                "metric": "total of median seconds per query",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )
    spark.sql(f"DROP DATABASE {db} CASCADE")
    spark.stop()


if __name__ == "__main__":
    main()

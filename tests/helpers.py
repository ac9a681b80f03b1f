from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivals_engine import schemas
from arrivals_engine.operators.decode import Lookups, checked_lookups

ARRIVAL = dict(
    admnum=1.0,
    i94yr=2016.0,
    i94mon=2.0,
    i94cit=101.0,
    i94addr="NY",
    i94port="NYC",
    arrdate=20485.0,
    depdate=20490.0,
    i94mode=1.0,
    i94bir=40.0,
    biryear=1976.0,
    i94visa=2.0,
    visatype="B2",
    dtaddto="07312016",
    gender="F",
)


def arrivals(spark: SparkSession, *changes: dict) -> DataFrame:
    """One raw arrival per argument, each like ARRIVAL but for the given fields."""
    rows = [ARRIVAL | change for change in changes]
    names = [name for name, _, _ in schemas.ARRIVAL_COLUMNS]
    return spark.createDataFrame(
        [tuple(row[name] for name in names) for row in rows], schemas.ARRIVALS_RAW
    )


def lookup_frames(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        spark.createDataFrame(
            [("NYC", "NEW YORK", "NY"), ("SEA", "SEATTLE", "WA"), ("XXX", None, None)],
            "port_code string, port_city string, port_state_code string",
        ),
        spark.createDataFrame(
            [("NY", "NEW YORK"), ("WA", "WASHINGTON")],
            "dest_state_code string, dest_state_name string",
        ),
        spark.createDataFrame(
            [("101", "ALBANIA"), ("0102", "ANDORRA"), ("INVALID", "NOWHERE")],
            "origin_code string, origin_country string",
        ),
    )


def lookups(spark: SparkSession, **options) -> Lookups:
    return checked_lookups(*lookup_frames(spark), **options)


def plan(frame: DataFrame) -> str:
    """The physical plan as planned, before adaptive changes."""
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(frame: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=str)

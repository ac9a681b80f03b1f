"""Arrivals, lookups and demographics derived from the order tables.

There are no arrival records to test with, so orders and customers stand in for
them. Modulo rules plant missing values, exact copies and unknown codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals_engine.functions.dates import DAY_ZERO
from arrivals_engine.operators.quality import MOST_BROADCAST_KEYS


class Tables:
    """The test tables of one directory as attributes, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, frame)
        return frame


def _unless(divisor: int, value: Column) -> Column:
    """Null where the order key is a multiple of the divisor."""
    return F.when(F.col("o_orderkey") % divisor != 0, value)


def raw_arrivals(t: Tables) -> DataFrame:
    orders = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("day"),
    )
    customers = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    # Counted, as Spark guesses their size from compressed files: a million would be broadcast.
    if customers.count() > MOST_BROADCAST_KEYS:
        customers = customers.hint("merge")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    number = F.datediff(F.col("day"), F.lit(DAY_ZERO).cast("date"))
    year = F.year("day")
    rows = joined.select(
        # Numbers with a fraction, which is cut off.
        (_unless(97, key).cast("double") + F.when(key % 101 == 0, 0.5).otherwise(0.0)).alias("admnum"),
        year.cast("double").alias("i94yr"),
        F.month("day").cast("double").alias("i94mon"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        _unless(71, F.concat(F.lit("S"), (customer % 8).cast("string"))).alias("i94addr"),
        _unless(73, F.concat(F.lit("P"), (key % 30).cast("string"))).alias("i94port"),
        _unless(53, number).cast("double").alias("arrdate"),
        _unless(11, number + key % 90).cast("double").alias("depdate"),
        _unless(67, key % 5).cast("double").alias("i94mode"),
        # No number, and one that no int can hold: both are missing.
        F.when(key % 89 == 0, float("nan"))
        .otherwise(_unless(13, customer % 80).cast("double"))
        .alias("i94bir"),
        F.when(key % 79 == 0, 1e12)
        .otherwise(_unless(13, year - customer % 80).cast("double"))
        .alias("biryear"),
        (1 + key % 4).cast("double").alias("i94visa"),
        _unless(7, F.concat(F.lit("V"), F.substring("o_orderpriority", 1, 1))).alias("visatype"),
        _unless(3, F.col("c_mktsegment")).alias("dtaddto"),
        _unless(6, F.col("o_orderstatus")).alias("gender"),
        F.when(key % 50 == 0, 2).otherwise(1).alias("copies"),
    )
    # Every 50th record comes twice.
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def ports(t: Tables) -> DataFrame:
    return t.nation.select(
        F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("port_code"),
        F.col("n_name").alias("port_city"),
        F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("port_state_code"),
    )


def destinations(t: Tables) -> DataFrame:
    return t.region.select(
        F.concat(F.lit("S"), F.col("r_regionkey").cast("string")).alias("dest_state_code"),
        F.col("r_name").alias("dest_state_name"),
    )


def origins(t: Tables) -> DataFrame:
    """The codes of nations from 20 on are no numbers, so their visits find no origin."""
    number = F.col("n_nationkey").cast("string")
    return t.nation.select(
        F.when(F.col("n_nationkey") < 20, number).otherwise(F.concat(F.lit("N"), number)).alias("origin_code"),
        F.concat(F.lit("C_"), F.col("n_name")).alias("origin_country"),
    )


def raw_demographics(t: Tables) -> DataFrame:
    """One nested record per city and market segment, the segment standing for race. The
    cities of nations from 22 on are in a state that no port is in."""
    counted = (
        t.customer.groupBy("c_nationkey", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("race_count"))
        # A handful of segments per nation is left by now.
        .withColumn("total", F.sum("race_count").over(Window.partitionBy("c_nationkey")))
    )
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = counted.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("n_nationkey")
    male = F.floor(F.col("total") / 2).cast("long")
    return rows.select(
        F.lit("places").alias("datasetid"),
        F.concat_ws("-", key.cast("string"), "c_mktsegment").alias("recordid"),
        F.lit("2015-01-01T00:00:00").alias("record_timestamp"),
        F.struct(
            F.col("n_name").alias("city"),
            F.when(key < 22, F.concat(F.lit("S"), F.col("n_regionkey").cast("string")))
            .otherwise("Z")
            .alias("state_code"),
            F.col("r_name").alias("state"),
            F.col("c_mktsegment").alias("race"),
            F.col("race_count").alias("count"),
            male.alias("male_population"),
            (F.col("total") - male).alias("female_population"),
            F.col("total").alias("total_population"),
            (key * 100).cast("long").alias("number_of_veterans"),
            (key * 1000).cast("long").alias("foreign_born"),
            (30 + key / 2).alias("median_age"),
            (2 + (key % 10) / 10).alias("average_household_size"),
        ).alias("fields"),
    )

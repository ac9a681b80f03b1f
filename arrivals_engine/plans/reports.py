"""The analytic reports over the star schema.

Every report counts per key before it joins (one may skip that where keys are known
to be unique), so that joins see one row per key and a port, date or visitor with
very many rows is no burden. Ties in sorted reports are broken by the key.

All but visits_by_month_gender take the kept counts of months in place of the fact: each publish
replaces or adds those of its months, so reports over all history read a few rows a month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP = 10
VISITS = "visitor_cnt"


#: What the kept counts are counted by, and the keys of each.
COUNTED_BY = {
    "port": ("port_city", "port_state_code"),
    "visa": ("visa_category",),
    "origin": ("origin_country",),
    "mode": ("entry_mode",),
}


def month_counts(fact: DataFrame) -> DataFrame:
    """The counts of each month that the reports need, in one pass over its visits."""
    keys = [key for of in COUNTED_BY.values() for key in of]
    sets = [["year_month", *of] for of in COUNTED_BY.values()]
    # grouping() is 1 where a key is not one of the row's.
    name = F.coalesce(
        *(F.when(F.grouping(of[0]) == 0, F.lit(name)) for name, of in COUNTED_BY.items())
    )
    return fact.groupingSets(sets, "year_month", *keys).agg(
        F.count("admission_id").alias(VISITS), name.alias("counted_by")
    )


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """rows are the fact, or the kept counts."""
    if VISITS not in rows.columns:
        return rows.groupBy(*keys).agg(F.count("admission_id").alias(VISITS))
    wanted = set(keys) - {"year_month"}
    name = next(name for name, of in reversed(COUNTED_BY.items()) if wanted <= set(of))
    return _summed(rows.filter(F.col("counted_by") == name), *keys)


def _summed(counted: DataFrame, *keys: str) -> DataFrame:
    return counted.groupBy(*keys).agg(F.sum(VISITS).alias(VISITS))


def _most_visits_first(counted: DataFrame, *ties: str) -> DataFrame:
    return counted.orderBy(F.desc(VISITS), *(F.asc_nulls_last(t) for t in ties))


def visits_by_port(fact: DataFrame) -> DataFrame:
    return _counted(fact, "port_city")


def top_ports(fact: DataFrame, limit: int = TOP) -> DataFrame:
    return _most_visits_first(visits_by_port(fact), "port_city").limit(limit)


def visits_by_month_gender(
    fact: DataFrame, visitors: DataFrame, arrival_date: DataFrame, gated: bool = False
) -> DataFrame:
    """Fact joined to visitors and dates, counted by year, month and gender.

    Rows are counted per key on both sides before the join. If keys repeat, each
    pair still counts once: the product of the two counts is the number of pairs.

    `gated` says that both tables were published through the key check. A key then
    has one row per month at most, so the rows are joined as they are, which saves
    a shuffle and two aggregations. The result is the same.

    Both sides have about a row per visit and are merged: Spark guesses the size of a few
    columns from compressed files, and would broadcast millions of rows.
    """
    key = ["admission_id", "arrival_date"]
    if gated:
        pairs = fact.select(*key).join(visitors.select(*key, "gender").hint("merge"), key)
        per_day = pairs.groupBy("arrival_date", "gender").agg(F.count(F.lit(1)).alias(VISITS))
    else:
        fact_rows = fact.groupBy(*key).agg(F.count(F.lit(1)).alias("fact_rows"))
        visitor_rows = visitors.groupBy(*key, "gender").agg(
            F.count(F.lit(1)).alias("visitor_rows")
        )
        per_day = (
            fact_rows.join(visitor_rows.hint("merge"), key)
            .groupBy("arrival_date", "gender")
            .agg(F.sum(F.col("fact_rows") * F.col("visitor_rows")).alias(VISITS))
        )
    return _summed(per_day.join(arrival_date, "arrival_date"), "year", "month", "gender")


def visits_by_port_population(fact: DataFrame, totals: DataFrame) -> DataFrame:
    """Ports without demographics keep a null population."""
    ports = _counted(fact, "port_city", "port_state_code")
    cities = totals.select(
        F.col("city").alias("port_city"),
        F.col("state_code").alias("port_state_code"),
        "total_population",
    )
    with_population = ports.join(cities, ["port_city", "port_state_code"], "left")
    return _summed(with_population, "port_city", "total_population")


def top_ports_population(fact: DataFrame, totals: DataFrame, limit: int = TOP) -> DataFrame:
    return _most_visits_first(
        visits_by_port_population(fact, totals), "port_city", "total_population"
    ).limit(limit)


def visits_by_visa(fact: DataFrame) -> DataFrame:
    return _most_visits_first(_counted(fact, "visa_category"), "visa_category")


def visits_by_origin(fact: DataFrame) -> DataFrame:
    return _counted(fact, "origin_country")


def top_origins(fact: DataFrame, limit: int = TOP) -> DataFrame:
    return _most_visits_first(visits_by_origin(fact), "origin_country").limit(limit)


def visits_by_month(fact: DataFrame) -> DataFrame:
    return _counted(fact, "year_month")


def visits_by_mode(fact: DataFrame) -> DataFrame:
    return _counted(fact, "entry_mode")


def port_diversity(fact: DataFrame, totals: DataFrame, races: DataFrame) -> DataFrame:
    """Visits, household size and population by race of each port city."""
    port = ["port_city", "port_state_code"]
    household = totals.select(
        F.col("city").alias("port_city"),
        F.col("state_code").alias("port_state_code"),
        "average_household_size",
    )
    by_race = races.select(
        F.col("city").alias("port_city"),
        F.col("state_code").alias("port_state_code"),
        "race",
        F.col("count").alias("race_population"),
    )
    return _counted(fact, *port).join(household, port, "left").join(by_race, port, "left")

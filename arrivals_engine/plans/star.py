"""The fact and dimension builders: DataFrame in, lazy DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_engine.functions import categories, dates
from arrivals_engine.operators.clean import clean_arrivals, type_arrivals
from arrivals_engine.operators.decode import Lookups, decode, hot_codes_of
from arrivals_engine.schemas import (
    ARRIVAL_DATE,
    DEMOGRAPHIC_FIELDS,
    STATE_DEMOGRAPHICS,
    STATE_DEMOGRAPHICS_BY_RACE,
    VISITOR_ANALYSIS,
    VISITORS,
)


def derive_visits(decoded: DataFrame) -> DataFrame:
    """Business names and derived columns of cleaned and decoded arrivals."""
    return decoded.select(
        F.col("admnum").alias("admission_id"),
        dates.year_month(F.col("i94yr"), F.col("i94mon")).alias("year_month"),
        dates.day_number_to_date(F.col("arrdate")).alias("arrival_date"),
        dates.day_number_to_date(F.col("depdate")).alias("departure_date"),
        F.col("i94bir").alias("visitor_age"),
        F.col("biryear").alias("visitor_birth_year"),
        "visatype",
        "gender",
        "port_city",
        "port_state_code",
        "dest_state_code",
        "origin_country",
        categories.entry_mode(F.col("i94mode")).alias("entry_mode"),
        categories.visa_category(F.col("i94visa")).alias("visa_category"),
        F.col("dtaddto").alias("visa_expire_date"),
        categories.same_state_flag(F.col("dest_state_code"), F.col("port_state_code")).alias(
            "port_dest_equal_flag"
        ),
    )


def build_visits(raw: DataFrame, lookups: Lookups) -> DataFrame:
    """One row per distinct arrival with an id, with all columns of fact and visitors."""
    hot = hot_codes_of(type_arrivals(raw), lookups)
    return derive_visits(decode(clean_arrivals(raw), lookups, hot))


def visit_fact(visits: DataFrame) -> DataFrame:
    return visits.select(*VISITOR_ANALYSIS.names)


def visitor_dim(visits: DataFrame) -> DataFrame:
    return visits.select(*VISITORS.names)


def arrival_date_dim(visits: DataFrame) -> DataFrame:
    """Distinct dates first; the calendar parts are then worked out once per date."""
    distinct = visits.select("arrival_date").distinct()
    return distinct.select("arrival_date", *dates.calendar_parts(F.col("arrival_date"))).select(
        *ARRIVAL_DATE.names
    )


def flatten_demographics(raw: DataFrame) -> DataFrame:
    """The twelve nested fields as columns, without the envelope."""
    return raw.select(*(F.col(f"fields.{name}").alias(name) for name, _ in DEMOGRAPHIC_FIELDS))


def demographic_totals(flat: DataFrame) -> DataFrame:
    """One row per distinct set of city totals; races repeat them."""
    return flat.select(*STATE_DEMOGRAPHICS.names).distinct()


def demographic_races(flat: DataFrame) -> DataFrame:
    return flat.select(*STATE_DEMOGRAPHICS_BY_RACE.names).distinct()


def narrow_totals(totals: DataFrame) -> DataFrame:
    """Totals in the types of the final table. Comes after the distinct, so that
    rows which differ only beyond the kept digits still fail the key check."""
    return totals.select(
        *(
            F.col(c.name).try_cast(c.frame_type).alias(c.name)
            for c in STATE_DEMOGRAPHICS.columns
        )
    )

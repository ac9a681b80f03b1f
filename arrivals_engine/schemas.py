"""Column lists, keys and types of every input and table."""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Column:
    name: str
    sql_type: str
    required: bool = False

    @property
    def width(self) -> int | None:
        """Declared length of a VARCHAR column, else None."""
        match = re.fullmatch(r"VARCHAR\((\d+)\)", self.sql_type)
        return int(match.group(1)) if match else None

    @property
    def is_decimal(self) -> bool:
        return self.sql_type.startswith("DECIMAL")

    @property
    def frame_type(self) -> str:
        """Type inside DataFrames: lengths are enforced only by tables."""
        return "STRING" if self.width else self.sql_type

    @property
    def ddl(self) -> str:
        return f"`{self.name}` {self.sql_type}" + (" NOT NULL" if self.required else "")


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    partition: str | None = None
    sub_partition: str | None = None

    @property
    def partitions(self) -> list[str]:
        return [c for c in (self.partition, self.sub_partition) if c]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]


# ---- inputs ---------------------------------------------------------------

# Raw arrivals carry every number as a double; the second type is the cleaned one.
ARRIVAL_COLUMNS = (
    ("admnum", "double", "bigint"),
    ("i94yr", "double", "int"),
    ("i94mon", "double", "int"),
    ("i94cit", "double", "int"),
    ("i94addr", "string", "string"),
    ("i94port", "string", "string"),
    ("arrdate", "double", "int"),
    ("depdate", "double", "int"),
    ("i94mode", "double", "int"),
    ("i94bir", "double", "int"),
    ("biryear", "double", "int"),
    ("i94visa", "double", "int"),
    ("visatype", "string", "string"),
    ("dtaddto", "string", "string"),
    ("gender", "string", "string"),
)
ARRIVALS_RAW = ", ".join(f"{name} {raw}" for name, raw, _ in ARRIVAL_COLUMNS)

PORT_COLUMNS = ("port_code", "port_city", "port_state_code")
DESTINATION_COLUMNS = ("dest_state_code", "dest_state_name")
ORIGIN_COLUMNS = ("origin_code", "origin_country")

DEMOGRAPHIC_FIELDS = (
    ("city", "string"),
    ("state_code", "string"),
    ("state", "string"),
    ("race", "string"),
    ("count", "bigint"),
    ("male_population", "bigint"),
    ("female_population", "bigint"),
    ("total_population", "bigint"),
    ("number_of_veterans", "bigint"),
    ("foreign_born", "bigint"),
    ("median_age", "double"),
    ("average_household_size", "double"),
)
DEMOGRAPHICS_RAW = "datasetid string, recordid string, record_timestamp string, fields struct<{}>".format(
    ", ".join(f"`{name}`: {kind}" for name, kind in DEMOGRAPHIC_FIELDS)
)

# ---- star schema ----------------------------------------------------------

VISIT_KEY = ("admission_id", "arrival_date")

VISITOR_ANALYSIS = Table(
    "visitor_analysis",
    (
        Column("admission_id", "BIGINT", True),
        Column("year_month", "INT", True),
        Column("arrival_date", "DATE", True),
        Column("dest_state_code", "VARCHAR(10)"),
        Column("port_city", "VARCHAR(256)"),
        Column("port_state_code", "VARCHAR(10)"),
        Column("entry_mode", "VARCHAR(10)"),
        Column("visa_category", "VARCHAR(20)"),
        Column("origin_country", "VARCHAR(256)"),
        Column("port_dest_equal_flag", "VARCHAR(1)"),
    ),
    key=VISIT_KEY,
    partition="year_month",
)

VISITORS = Table(
    "visitors",
    (
        Column("admission_id", "BIGINT", True),
        Column("year_month", "INT", True),
        Column("origin_country", "VARCHAR(256)"),
        Column("dest_state_code", "VARCHAR(10)"),
        Column("port_city", "VARCHAR(256)"),
        Column("port_state_code", "VARCHAR(10)"),
        Column("entry_mode", "VARCHAR(10)"),
        Column("visitor_age", "INT"),
        Column("visitor_birth_year", "INT"),
        Column("arrival_date", "DATE", True),
        Column("departure_date", "DATE"),
        Column("visa_category", "VARCHAR(20)"),
        Column("visatype", "VARCHAR(10)"),
        Column("visa_expire_date", "VARCHAR(20)"),
        Column("gender", "VARCHAR(10)"),
    ),
    key=VISIT_KEY,
    partition="year_month",
)

ARRIVAL_DATE = Table(
    "arrival_date",
    (
        Column("arrival_date", "DATE", True),
        Column("year", "INT"),
        Column("month", "INT"),
        Column("day", "INT"),
        Column("weekday", "INT"),
        Column("weeknum", "INT"),
    ),
    key=("arrival_date",),
)

STATE_DEMOGRAPHICS = Table(
    "state_demographics",
    (
        Column("city", "VARCHAR(256)", True),
        Column("state_code", "VARCHAR(2)", True),
        Column("state", "VARCHAR(256)"),
        Column("median_age", "DECIMAL(3,1)"),
        Column("male_population", "BIGINT"),
        Column("female_population", "BIGINT"),
        Column("total_population", "BIGINT", True),
        Column("number_of_veterans", "BIGINT"),
        Column("foreign_born", "BIGINT"),
        Column("average_household_size", "DECIMAL(4,2)"),
    ),
    key=("city", "state_code"),
)

STATE_DEMOGRAPHICS_BY_RACE = Table(
    "state_demographics_by_race",
    (
        Column("city", "VARCHAR(256)", True),
        Column("state_code", "VARCHAR(2)", True),
        Column("state", "VARCHAR(256)"),
        Column("race", "VARCHAR(256)"),
        Column("count", "BIGINT", True),
    ),
    key=("city", "state_code", "race"),
)

# ---- kept beside the star, so that a publish need not read what is published -------

#: The keys of fact and visitors. A key is looked for among those of its month of arrival only,
#: and a month that is published again takes the place of its own keys.
VISIT_KEYS = Table(
    "visit_keys",
    (
        Column("admission_id", "BIGINT", True),
        Column("arrival_date", "DATE", True),
        Column("in_visitor_analysis", "BOOLEAN", True),
        Column("in_visitors", "BOOLEAN", True),
        Column("year_month", "INT", True),
        Column("arrival_month", "INT", True),
    ),
    key=VISIT_KEY,
    partition="year_month",
    sub_partition="arrival_month",
)

#: How many visits of each month came on each date: a date without any leaves the dimension.
DATE_VISITS = Table(
    "date_visits",
    (
        Column("arrival_date", "DATE", True),
        Column("year_month", "INT", True),
        Column("visits", "BIGINT", True),
    ),
)

#: Visits of each month by what the reports count by. Each row is of one report's keys, named in
#: ``counted_by``; the others are null.
MONTH_COUNTS = Table(
    "month_counts",
    (
        Column("counted_by", "STRING", True),
        Column("port_city", "STRING"),
        Column("port_state_code", "STRING"),
        Column("visa_category", "STRING"),
        Column("origin_country", "STRING"),
        Column("entry_mode", "STRING"),
        Column("year_month", "INT", True),
        Column("visitor_cnt", "BIGINT", True),
    ),
)

# ---- staging: nothing required, so that a bad batch can be inspected -------


def _union_columns(*tables: Table) -> tuple[Column, ...]:
    seen: dict[str, Column] = {}
    for table in tables:
        for column in table.columns:
            seen.setdefault(column.name, Column(column.name, column.sql_type))
    return tuple(seen.values())


# One wide table holds the batches, each under its name; the three staged star tables are
# views of it.
STAGE_VISITS = Table(
    "stage_visits",
    (*_union_columns(VISITOR_ANALYSIS, VISITORS), Column("batch", "STRING")),
    partition="batch",
)

# Demographic measures are staged as read, so that a value too wide for its
# final type is counted by the gate instead of being lost.
STAGE_STATE_DEMOGRAPHICS = Table(
    "stage_state_demographics",
    tuple(
        Column(c.name, "DOUBLE" if c.is_decimal else c.frame_type)
        for c in STATE_DEMOGRAPHICS.columns
    ),
)
STAGE_STATE_DEMOGRAPHICS_BY_RACE = Table(
    "stage_state_demographics_by_race",
    tuple(Column(c.name, c.frame_type) for c in STATE_DEMOGRAPHICS_BY_RACE.columns),
)

FINAL_TABLES = (
    VISITOR_ANALYSIS,
    VISITORS,
    ARRIVAL_DATE,
    STATE_DEMOGRAPHICS,
    STATE_DEMOGRAPHICS_BY_RACE,
)
KEPT_TABLES = (VISIT_KEYS, DATE_VISITS, MONTH_COUNTS)
STAGE_TABLES = (STAGE_VISITS, STAGE_STATE_DEMOGRAPHICS, STAGE_STATE_DEMOGRAPHICS_BY_RACE)
STAGE_VIEWS = {
    f"stage_{table.name}": table for table in (VISITOR_ANALYSIS, VISITORS, ARRIVAL_DATE)
}

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from arrivals_engine.functions import categories, dates


def test_day_numbers(spark):
    frame = spark.createDataFrame([(0,), (20485,), (-1,), (None,)], "n int")
    found = [r[0] for r in frame.select(dates.day_number_to_date(F.col("n"))).collect()]
    assert found == [
        datetime.date(1960, 1, 1),
        datetime.date(2016, 2, 1),
        datetime.date(1959, 12, 31),
        None,
    ]


def test_year_month_is_padded_and_sorts(spark):
    frame = spark.createDataFrame(
        [(2016, 2), (2016, 12), (2017, 1), (None, 1), (2016, None), (2**31 - 1, 1)], "y int, m int"
    )
    found = frame.select(
        dates.year_month(F.col("y"), F.col("m")), dates.year_month_text(F.col("y"), F.col("m"))
    ).collect()
    assert [r[0] for r in found] == [201602, 201612, 201701, None, None, None]
    assert [r[1] for r in found][:5] == ["20162", "201612", "20171", None, None]


@pytest.mark.parametrize(
    ("day", "parts"),
    [
        ("2016-01-01", (2016, 1, 1, 6, 53)),
        ("2016-01-03", (2016, 1, 3, 1, 53)),
        ("2016-01-09", (2016, 1, 9, 7, 1)),
        ("1960-01-01", (1960, 1, 1, 6, 53)),
    ],
)
def test_calendar_parts(spark, day, parts):
    frame = spark.sql(f"SELECT date'{day}' AS d")
    assert tuple(frame.select(*dates.calendar_parts(F.col("d"))).first()) == parts


def test_categories(spark):
    frame = spark.createDataFrame([(c,) for c in (1, 2, 3, 0, 9, None)], "c int")
    found = frame.select(
        categories.entry_mode(F.col("c")), categories.visa_category(F.col("c"))
    ).collect()
    assert [tuple(r) for r in found] == [
        ("Air", "Business"),
        ("Sea", "Pleasure"),
        ("Land", "Student"),
        ("N/R", "N/R"),
        ("N/R", "N/R"),
        ("N/R", "N/R"),
    ]


def test_flag(spark):
    frame = spark.createDataFrame(
        [("NY", "NY"), ("NY", "WA"), ("Other", "Other"), (None, None)], "a string, b string"
    )
    found = [r[0] for r in frame.select(categories.same_state_flag(F.col("a"), F.col("b"))).collect()]
    assert found == ["Y", "N", "Y", "N"]

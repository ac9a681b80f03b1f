"""Day numbers, year-months and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day 0 of the day numbers in the arrival records.
DAY_ZERO = "1960-01-01"


def day_number_to_date(days: Column) -> Column:
    return F.date_add(F.lit(DAY_ZERO).cast("date"), days)


def year_month(year: Column, month: Column) -> Column:
    """YYYYMM as an int that sorts by time; null if a part is missing or absurd."""
    return F.try_add(F.try_multiply(year, F.lit(100)), month)


def year_month_text(year: Column, month: Column) -> Column:
    """Year and month put together without padding, as older extracts have it."""
    return F.concat(year.cast("string"), month.cast("string"))


#: The calendar parts of a date, weekday 1 being Sunday and weeks those of ISO.
CALENDAR = {
    "year": "year",
    "month": "month",
    "day": "day",
    "weekday": "dayofweek",
    "weeknum": "weekofyear",
}


def calendar_parts(date: Column) -> list[Column]:
    """Year, month, day, weekday (1 = Sunday) and ISO week of a date."""
    return [F.call_function(name, date).alias(part) for part, name in CALENDAR.items()]


def month_of(date: Column) -> Column:
    """The month of a date as a number, YYYYMM."""
    return F.year(date) * 100 + F.month(date)

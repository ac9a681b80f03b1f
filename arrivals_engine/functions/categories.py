"""Codes to category names, and the same-state flag."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NOT_REPORTED = "N/R"
ENTRY_MODES = {1: "Air", 2: "Sea", 3: "Land"}
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}


def _named(code: Column, names: dict[int, str]) -> Column:
    cases = reduce(lambda acc, kv: acc.when(code == kv[0], kv[1]), names.items(), F)
    return cases.otherwise(NOT_REPORTED)


def entry_mode(code: Column) -> Column:
    return _named(code, ENTRY_MODES)


def visa_category(code: Column) -> Column:
    return _named(code, VISA_CATEGORIES)


def same_state_flag(destination: Column, port_state: Column) -> Column:
    """'Y' where both are equal. Two unknown states are both 'Other', hence 'Y'."""
    return F.when(destination == port_state, "Y").otherwise("N")

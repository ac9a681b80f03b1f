from __future__ import annotations

import datetime
import random
from collections import Counter

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from arrivals_engine import catalogue, schemas
from arrivals_engine.plans import reports, star

SF_DIR = "/root/testdata/sf0.001"
DAY = datetime.date(2016, 1, 1)


def ports(spark, counts):
    values = [(city, i) for city, n in counts.items() for i in range(n)]
    return spark.createDataFrame(values, "port_city string, admission_id bigint").withColumns(
        {"port_state_code": F.lit("S"), "origin_country": F.col("port_city"),
         "visa_category": F.col("port_city")}
    )


def test_top_ports_are_sorted_and_ties_broken_by_name(spark):
    fact = ports(spark, {"b": 2, "a": 2, "c": 3} | {f"x{i:02}": 1 for i in range(12)})
    found = [tuple(r) for r in reports.top_ports(fact).collect()]
    assert found[:3] == [("c", 3), ("a", 2), ("b", 2)]
    assert found[3:] == [(f"x{i:02}", 1) for i in range(7)]
    assert [tuple(r) for r in reports.top_origins(fact).collect()] == found


def test_visa_report_is_wholly_sorted(spark):
    fact = ports(spark, {f"v{i:02}": 1 + i % 4 for i in range(14)})
    counts = [r.visitor_cnt for r in reports.visits_by_visa(fact).collect()]
    assert len(counts) == 14
    assert counts == sorted(counts, reverse=True)


def test_counts_skip_null_ids(spark):
    fact = spark.createDataFrame([("a", None), ("a", 1)], "port_city string, admission_id bigint")
    assert rows(reports.visits_by_port(fact)) == [("a", 1)]


def test_top_k_is_one_operator(spark):
    text = plan(reports.top_ports(ports(spark, {"a": 1})))
    assert "TakeOrderedAndProject" in text


def brute_force_month_gender(fact, visitors, dates):
    counts = Counter()
    for f_id, f_day in fact:
        for v_id, v_day, gender in visitors:
            if f_id is None or (f_id, f_day) != (v_id, v_day):
                continue
            for day, year, month in dates:
                if day == f_day:
                    counts[year, month, gender] += 1
    return sorted(((*k, n) for k, n in counts.items()), key=str)


def month_gender(spark, fact, visitors, dates, gated=False):
    return reports.visits_by_month_gender(
        spark.createDataFrame(fact, "admission_id bigint, arrival_date date"),
        spark.createDataFrame(visitors, "admission_id bigint, arrival_date date, gender string"),
        spark.createDataFrame(dates, "arrival_date date, year int, month int"),
        gated,
    )


@pytest.mark.parametrize("gated", [False, True])
def test_month_gender_on_repeated_and_missing_keys(spark, gated):
    pick = random.Random(7)
    days = [DAY + datetime.timedelta(days=40 * i) for i in range(4)]
    fact = [(pick.choice([1, 1, 1, 2, 3, None]), pick.choice(days)) for _ in range(60)]
    visitors = [
        (pick.choice([1, 1, 2, 4, None]), pick.choice(days), pick.choice(["F", "M", None]))
        for _ in range(60)
    ]
    dates = [(d, d.year, d.month) for d in days[:3]] + [(days[0], 1999, 1)]
    found = rows(month_gender(spark, fact, visitors, dates, gated))
    assert found == brute_force_month_gender(fact, visitors, dates)


def test_month_gender_counts_keys_before_joining(spark):
    """A key that both sides have 3000 times gives nine million pairs; they are
    counted, not produced."""
    fact = [(1, DAY)] * 3000 + [(2, DAY)]
    visitors = [(1, DAY, "F")] * 3000 + [(2, DAY, "M")]
    frame = month_gender(spark, fact, visitors, [(DAY, 2016, 1)])
    assert rows(frame) == [(2016, 1, "F", 9_000_000), (2016, 1, "M", 1)]
    text = plan(frame)
    for side in ("fact_rows", "visitor_rows"):
        assert side in text


@pytest.mark.parametrize("gated", [False, True])
def test_month_gender_merges_visits(spark, tmp_path, gated):
    """However small the files of their keys are."""
    given = {
        "fact": spark.createDataFrame([(1, DAY)], "admission_id bigint, arrival_date date"),
        "visitors": spark.createDataFrame([(1, DAY, "F")], "admission_id bigint, arrival_date date, gender string"),
        "dates": spark.createDataFrame([(DAY, 2016, 1)], "arrival_date date, year int, month int"),
    }
    for name, frame in given.items():
        frame.write.parquet(str(tmp_path / name))
    frame = reports.visits_by_month_gender(*(spark.read.parquet(str(tmp_path / name)) for name in given), gated)
    assert "SortMergeJoin [admission_id" in plan(frame) and rows(frame) == [(2016, 1, "F", 1)]


def totals(spark, *values):
    return spark.createDataFrame(
        list(values),
        "city string, state_code string, total_population bigint, average_household_size double",
    )


def test_population_is_null_without_demographics(spark):
    fact = ports(spark, {"a": 2, "b": 1})
    found = reports.top_ports_population(fact, totals(spark, ("a", "S", 100, 2.0), ("b", "T", 5, 1.0)))
    assert [tuple(r) for r in found.collect()] == [("a", 100, 2), ("b", None, 1)]


def test_cities_of_one_name_and_population_are_counted_together(spark):
    fact = ports(spark, {"a": 2}).union(
        ports(spark, {"a": 3}).withColumn("port_state_code", F.lit("T"))
    )
    found = reports.visits_by_port_population(
        fact, totals(spark, ("a", "S", 100, 2.0), ("a", "T", 100, 2.0))
    )
    assert rows(found) == [("a", 100, 5)]


def test_races_do_not_multiply_visits(spark):
    fact = ports(spark, {"a": 5, "b": 1})
    races = spark.createDataFrame(
        [("a", "S", "x", 1), ("a", "S", "y", 2)],
        "city string, state_code string, race string, count bigint",
    )
    found = reports.port_diversity(fact, totals(spark, ("a", "S", 100, 2.5)), races).select(
        "port_city", "visitor_cnt", "average_household_size", "race", "race_population"
    )
    assert rows(found) == [
        ("a", 5, 2.5, "x", 1),
        ("a", 5, 2.5, "y", 2),
        ("b", 1, None, None, None),
    ]


def test_all_breakdowns_sum_to_the_fact(spark):
    fact = star.visit_fact(catalogue.queries()["visits"](spark, SF_DIR)).cache()
    for breakdown in (
        reports.visits_by_port(fact),
        reports.visits_by_visa(fact),
        reports.visits_by_origin(fact),
        reports.visits_by_month(fact),
        reports.visits_by_mode(fact),
    ):
        assert breakdown.agg(F.sum("visitor_cnt")).first()[0] == fact.count() == 1484


def test_reports_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "fact")
    catalogue.queries()["visit_fact"](spark, SF_DIR).write.parquet(path)
    fact = spark.read.parquet(path)
    text = plan(reports.top_ports(fact))
    assert "ReadSchema: struct<admission_id:bigint,port_city:string>" in text
    assert fact.columns == schemas.VISITOR_ANALYSIS.names

from __future__ import annotations

import datetime
import math
import random
from decimal import Decimal

import pytest
from helpers import arrivals, lookups, plan, rows

from arrivals_engine import catalogue, schemas
from arrivals_engine.fixtures import Tables, raw_arrivals
from arrivals_engine.operators import quality
from arrivals_engine.plans import star

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fixture_visits(spark):
    return catalogue.queries()["visits"](spark, SF_DIR).cache()


def frame_types(table):
    names = {"STRING": "string", "BIGINT": "bigint", "INT": "int", "DATE": "date"}
    return [(c.name, names.get(c.frame_type, c.frame_type.lower())) for c in table.columns]


def test_tables_have_the_declared_columns(spark):
    visits = star.build_visits(arrivals(spark, {}), lookups(spark))
    for rows_, table in (
        (star.visit_fact(visits), schemas.VISITOR_ANALYSIS),
        (star.visitor_dim(visits), schemas.VISITORS),
        (star.arrival_date_dim(visits), schemas.ARRIVAL_DATE),
    ):
        assert rows_.dtypes == frame_types(table)


def test_one_visit(spark):
    visits = star.build_visits(arrivals(spark, {}), lookups(spark))
    assert visits.first().asDict() | {"arrival_date": None, "departure_date": None} == {
        "admission_id": 1,
        "year_month": 201602,
        "arrival_date": None,
        "departure_date": None,
        "visitor_age": 40,
        "visitor_birth_year": 1976,
        "visatype": "B2",
        "gender": "F",
        "port_city": "NEW YORK",
        "port_state_code": "NY",
        "dest_state_code": "NY",
        "origin_country": "ALBANIA",
        "entry_mode": "Air",
        "visa_category": "Pleasure",
        "visa_expire_date": "07312016",
        "port_dest_equal_flag": "Y",
    }
    assert str(visits.first().arrival_date) == "2016-02-01"
    assert str(visits.first().departure_date) == "2016-02-06"


def test_missing_days_are_day_zero_and_in_the_date_dimension(spark):
    visits = star.build_visits(arrivals(spark, {"arrdate": None}, {}), lookups(spark))
    found = star.arrival_date_dim(visits)
    assert sorted(str(r.arrival_date) for r in found.collect()) == ["1960-01-01", "2016-02-01"]


def test_two_unknown_states_are_equal(spark):
    visits = star.build_visits(arrivals(spark, {"i94port": "?", "i94addr": "?"}), lookups(spark))
    row = visits.first()
    assert (row.port_state_code, row.dest_state_code) == ("Other", "Other")
    assert row.port_dest_equal_flag == "Y"


def test_same_key_with_another_attribute_survives_and_fails_the_check(spark):
    visits = star.build_visits(arrivals(spark, {}, {"gender": "M"}), lookups(spark))
    assert visits.count() == 2
    report = quality.table_report(star.visit_fact(visits), schemas.VISITOR_ANALYSIS)
    failed = report.filter("NOT passed").collect()
    assert [(r.check_name, r.value) for r in failed] == [("unique_key", 1)]


def expected_visit(raw):
    """The rules for one arrival in plain Python."""

    def whole(name, default=None):
        value = raw[name]
        return default if value is None or math.isnan(value) else int(value)

    def text(name):
        return "N/R" if raw[name] is None else raw[name]

    def day(name):
        return datetime.date(1960, 1, 1) + datetime.timedelta(days=whole(name, 0))

    city, state = {"NYC": ("NEW YORK", "NY"), "SEA": ("SEATTLE", "WA")}.get(
        raw["i94port"], ("Other", "Other")
    )
    destination = raw["i94addr"] if raw["i94addr"] in ("NY", "WA") else "Other"
    year, month = whole("i94yr"), whole("i94mon")
    return (
        whole("admnum"),
        None if year is None or month is None else year * 100 + month,
        day("arrdate"),
        day("depdate"),
        whole("i94bir", -1),
        whole("biryear", -1),
        text("visatype"),
        text("gender"),
        city,
        state,
        destination,
        {101: "ALBANIA", 102: "ANDORRA"}.get(whole("i94cit"), "Other"),
        {1: "Air", 2: "Sea", 3: "Land"}.get(whole("i94mode"), "N/R"),
        {1: "Business", 2: "Pleasure", 3: "Student"}.get(whole("i94visa"), "N/R"),
        text("dtaddto"),
        "Y" if destination == state else "N",
    )


@pytest.mark.parametrize("small", [True, False])
def test_random_arrivals_against_plain_python(spark, small):
    pick = random.Random(3)
    values = {
        "admnum": [None, 1.0, 2.0, 3.7, float("nan")],
        "i94yr": [2016.0, 2017.0, None],
        "i94mon": [1.0, 12.0, None],
        "i94cit": [101.0, 102.0, 103.0, None],
        "i94addr": ["NY", "WA", "ny", None],
        "i94port": ["NYC", "SEA", "XXX", None],
        "arrdate": [20485.0, 20485.9, -1.0, None],
        "depdate": [20490.0, None],
        "i94mode": [0.0, 1.0, 2.0, 3.0, None],
        "i94bir": [40.0, None],
        "biryear": [1976.0, None],
        "i94visa": [1.0, 2.0, 3.0, 4.0, None],
        "visatype": ["B2", None],
        "dtaddto": ["D/S", None],
        "gender": ["F", "M", None],
    }
    raw = [{name: pick.choice(v) for name, v in values.items()} for _ in range(150)]
    raw += [raw[0] | {"admnum": 9.0}] * 75 + pick.choices(raw, k=50)
    options = {} if small else {"max_broadcast_bytes": 0}
    found = star.build_visits(arrivals(spark, *raw), lookups(spark, **options)).collect()

    def typed(row):
        return tuple(
            int(v) if isinstance(v, float) and not math.isnan(v) else None if v != v else v
            for v in row.values()
        )

    distinct = {typed(row): row for row in raw}.values()
    expected = [expected_visit(row) for row in distinct if expected_visit(row)[0] is not None]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_fact_and_visitors_have_one_row_per_identified_arrival(spark, fixture_visits):
    identified = catalogue.queries()["arrivals_with_id"](spark, SF_DIR).count()
    assert star.visit_fact(fixture_visits).count() == identified
    assert star.visitor_dim(fixture_visits).count() == identified == 1484


def test_every_date_is_in_the_dimension(spark, fixture_visits):
    dates = star.arrival_date_dim(fixture_visits)
    assert fixture_visits.join(dates, "arrival_date", "left_anti").count() == 0
    assert dates.count() == 1071


def test_no_python_in_the_plan(spark):
    for name in ("visits", "arrival_date_dim", "demographics_total", "port_diversity"):
        text = plan(catalogue.queries()[name](spark, SF_DIR))
        assert "Python" not in text
        assert "Pandas" not in text


def city(**changes):
    fields = dict(
        city="SEATTLE",
        state_code="WA",
        state="WASHINGTON",
        race="White",
        count=10,
        male_population=50,
        female_population=50,
        total_population=100,
        number_of_veterans=1,
        foreign_born=2,
        median_age=33.15,
        average_household_size=2.5,
    )
    fields |= changes
    return ("set", "id", "now", tuple(fields[name] for name, _ in schemas.DEMOGRAPHIC_FIELDS))


def demographics(spark, *records):
    return star.flatten_demographics(
        spark.createDataFrame(list(records), schemas.DEMOGRAPHICS_RAW)
    )


def test_flat_demographics_have_only_the_fields(spark):
    flat = demographics(spark, city())
    assert flat.columns == [name for name, _ in schemas.DEMOGRAPHIC_FIELDS]


def test_totals_are_free_of_races(spark):
    flat = demographics(spark, city(), city(race="Asian", count=20), city())
    assert star.demographic_totals(flat).count() == 1
    assert rows(star.demographic_races(flat)) == [
        ("SEATTLE", "WA", "WASHINGTON", "Asian", 20),
        ("SEATTLE", "WA", "WASHINGTON", "White", 10),
    ]


def test_narrow_measures(spark):
    totals = star.demographic_totals(demographics(spark, city(median_age=33.15)))
    narrowed = star.narrow_totals(totals)
    assert narrowed.dtypes == frame_types(schemas.STATE_DEMOGRAPHICS)
    row = narrowed.first()
    assert (row.median_age, row.average_household_size) == (Decimal("33.2"), Decimal("2.50"))


def test_a_measure_that_does_not_fit_is_counted(spark):
    totals = star.demographic_totals(
        demographics(spark, city(median_age=100.0), city(city="TACOMA", median_age=None))
    )
    report = quality.table_report(totals, schemas.STATE_DEMOGRAPHICS, quality.ALL_CHECKS)
    failed = report.filter("NOT passed").collect()
    assert [(r.check_name, r.subject, r.value) for r in failed] == [("fit", "median_age", 1)]


def test_totals_that_differ_beyond_the_kept_digits_fail_the_key_check(spark):
    totals = star.demographic_totals(
        demographics(spark, city(median_age=33.11), city(median_age=33.12))
    )
    report = quality.table_report(totals, schemas.STATE_DEMOGRAPHICS)
    assert [r.check_name for r in report.filter("NOT passed").collect()] == ["unique_key"]


def test_tables_open_once(spark):
    t = Tables(spark, SF_DIR)
    assert t.nation is t.nation


@pytest.mark.parametrize("many", [False, True])
def test_many_customers_are_merged_however_small_their_files(spark, tmp_path, many):
    """As the driver would gather them all for a broadcast, each time arrivals are read."""
    n = quality.MOST_BROADCAST_KEYS + 1 if many else 10
    spark.range(n).selectExpr(
        "id AS c_custkey", "CAST(id % 25 AS int) AS c_nationkey", "'NO' AS c_mktsegment"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(
        [(1, 3, "O", "1-U"), (2, n - 1, "F", "2-H"), (3, n, "F", "2-H"), (4, None, "F", "2-H")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
    ).selectExpr("*", "TIMESTAMP '1995-02-01' AS o_orderdate").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    raw = raw_arrivals(Tables(spark, str(tmp_path)))
    assert ("BroadcastHashJoin" in plan(raw)) != many
    assert rows(raw.select("admnum", "i94cit")) == [(1.0, 3.0), (2.0, float((n - 1) % 25))]

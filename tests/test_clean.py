from __future__ import annotations

from helpers import ARRIVAL, arrivals, plan

from arrivals_engine.operators import clean


def test_numbers_are_cut_towards_zero_and_misfits_are_null(spark):
    raw = arrivals(
        spark,
        {"admnum": 2.9, "i94bir": -2.9},
        {"admnum": 9e18, "i94bir": float("nan")},
        {"admnum": 3.0, "i94bir": 1e20},
        {"admnum": None, "i94bir": None},
    )
    found = clean.type_arrivals(raw).select("admnum", "i94bir").collect()
    assert [tuple(r) for r in found] == [
        (2, -2),
        (9_000_000_000_000_000_000, None),
        (3, None),
        (None, None),
    ]


def test_types(spark):
    typed = clean.type_arrivals(arrivals(spark, {}))
    assert dict(typed.dtypes)["admnum"] == "bigint"
    assert {t for n, t in typed.dtypes if n.startswith("i94") and n not in ("i94addr", "i94port")} == {
        "int"
    }


def test_unused_columns_are_dropped(spark):
    raw = arrivals(spark, {}).selectExpr("*", "1 AS count", "'x' AS fltno")
    assert clean.type_arrivals(raw).columns == list(ARRIVAL)


def test_copies_collapse_with_nulls_equal(spark):
    raw = arrivals(spark, {"gender": None}, {"gender": None}, {"gender": "M"})
    assert clean.distinct_rows(clean.type_arrivals(raw)).count() == 2


def test_rows_equal_after_narrowing_are_copies(spark):
    raw = arrivals(spark, {"i94bir": 40.2}, {"i94bir": 40.7})
    assert clean.clean_arrivals(raw).count() == 1


def test_rows_without_id_go(spark):
    raw = arrivals(spark, {"admnum": None}, {"admnum": float("nan")}, {"admnum": 5.0})
    assert [r.admnum for r in clean.clean_arrivals(raw).collect()] == [5]


def test_dropping_ids_before_or_after_the_distinct_is_the_same(spark):
    raw = arrivals(spark, {"admnum": None}, {"admnum": None}, {}, {}, {"gender": None})
    typed = clean.type_arrivals(raw)
    after = clean.fill_unknowns(clean.with_id(clean.distinct_rows(typed)))
    assert sorted(after.collect()) == sorted(clean.clean_arrivals(raw).collect())


def test_defaults(spark):
    missing = {
        name: None
        for name in ("i94bir", "biryear", "arrdate", "depdate", "visatype", "dtaddto", "gender")
    }
    row = clean.clean_arrivals(arrivals(spark, missing)).first()
    assert (row.i94bir, row.biryear) == (-1, -1)
    assert (row.arrdate, row.depdate) == (0, 0)
    assert (row.visatype, row.dtaddto, row.gender) == ("N/R", "N/R", "N/R")


def test_other_fields_keep_nulls(spark):
    missing = dict.fromkeys(("i94yr", "i94mon", "i94cit", "i94addr", "i94port", "i94mode", "i94visa"))
    row = clean.clean_arrivals(arrivals(spark, missing)).first()
    assert {row[name] for name in missing} == {None}


def test_copies_are_collapsed_before_the_only_shuffle(spark):
    text = plan(clean.clean_arrivals(arrivals(spark, {})))
    assert text.count("Exchange hashpartitioning") == 1
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "HashAggregate" in before_shuffle
    assert "Filter" in before_shuffle

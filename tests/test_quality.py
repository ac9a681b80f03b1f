from __future__ import annotations

import pytest
from helpers import plan, rows

from arrivals_engine import schemas
from arrivals_engine.operators import quality

PAIR = schemas.Table(
    "pair",
    (schemas.Column("a", "VARCHAR(3)", True), schemas.Column("b", "VARCHAR(3)")),
    key=("a", "b"),
)


def pairs(spark, *values):
    return spark.createDataFrame(list(values), "a string, b string")


def failures(report):
    return {(r.check_name, r.subject): r.value for r in report.collect() if not r.passed}


def test_good_table_passes(spark):
    report = quality.table_report(pairs(spark, ("1", "2"), ("1", "3")), PAIR, quality.ALL_CHECKS)
    assert failures(report) == {}
    quality.gate(report)


def test_empty_table_fails_only_the_row_count(spark):
    report = quality.table_report(pairs(spark, ("1", "2")).limit(0), PAIR, quality.ALL_CHECKS)
    assert failures(report) == {("row_count", ""): 0}
    with pytest.raises(quality.QualityError, match="row_count"):
        quality.gate(report)


def test_glued_keys_do_not_collide(spark):
    assert failures(quality.table_report(pairs(spark, ("1", "23"), ("12", "3")), PAIR)) == {}


def test_repeated_keys_with_null_parts_count(spark):
    frame = pairs(spark, ("1", None), ("1", None), ("2", "x"), ("2", "x"), ("2", "x"))
    assert failures(quality.table_report(frame, PAIR)) == {("unique_key", "a,b"): 3}
    assert rows(quality.duplicate_keys(frame, PAIR.key)) == [("1", None, 2), ("2", "x", 3)]
    assert quality.surplus_rows(frame, PAIR.key).first()[0] == 3
    assert quality.surplus_rows(frame, PAIR.key, count_nulls=False).first()[0] == 2


def test_required_and_fit(spark):
    frame = pairs(spark, (None, "1"), (None, "2"), ("x", "1234"))
    assert failures(quality.table_report(frame, PAIR, quality.ALL_CHECKS)) == {
        ("required", "a"): 2,
        ("fit", "b"): 1,
    }


@pytest.mark.parametrize("check", quality.ALL_CHECKS)
def test_single_checks_agree_with_the_whole_report(spark, check):
    frame = pairs(spark, (None, "1"), (None, "1"), ("x", "1234"))
    whole = quality.table_report(frame, PAIR, quality.ALL_CHECKS)
    single = quality.table_report(frame, PAIR, (check,))
    assert rows(single) == rows(whole.filter(whole.check_name == check))


def test_whole_report_shuffles_keys_once_after_counting(spark):
    text = plan(quality.table_report(pairs(spark, ("1", "2")).repartition(4), PAIR))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange SinglePartition") == 1
    assert "partial_count" in text[text.index("Exchange hashpartitioning") :]


def test_counts_alone_do_not_shuffle_rows(spark):
    text = plan(quality.table_report(pairs(spark, ("1", "2")).repartition(4), PAIR, ("row_count",)))
    assert "hashpartitioning" not in text


def test_gate_names_every_failure(spark):
    bad = pairs(spark, (None, "1"), (None, "1"))
    with pytest.raises(quality.QualityError) as error:
        quality.gate(quality.batch_report([(bad, PAIR), (bad.limit(0), PAIR)]))
    assert "pair: unique_key(a,b) = 1" in str(error.value)
    assert "pair: required(a) = 2" in str(error.value)
    assert "pair: row_count() = 0" in str(error.value)


def test_lineitem_fails_the_key_check(spark):
    table = schemas.Table("lineitem", (), key=("l_orderkey", "l_linenumber"))
    report = quality.table_report(spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet"), table)
    assert failures(report) == {("unique_key", "l_orderkey,l_linenumber"): 14168}


def test_collisions_with_published_keys(spark):
    batch = pairs(spark, ("1", "1"), ("1", "1"), ("2", "2"), ("3", None))
    published = pairs(spark, ("1", "1"), ("3", None), ("9", "9"))
    assert [(r.check_name, r.value, r.passed) for r in
            quality.collision_report(batch, published, PAIR).collect()] == [("new_key", 1, False)]
    assert quality.collision_report(batch, published.limit(0), PAIR).first().passed

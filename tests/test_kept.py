"""What is kept beside the published tables, batches side by side, and what a load counts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse
from uuid import uuid4

import pytest
from helpers import arrivals, lookups, plan, rows
from pyspark.sql import functions as F

from arrivals_engine import schemas
from arrivals_engine.catalogue import new_warehouse
from arrivals_engine.operators import clean, quality
from arrivals_engine.operators.quality import QualityError
from arrivals_engine.plans import publish, star
from arrivals_engine.sources import readers, tables


@pytest.fixture
def db(spark):
    name = new_warehouse(spark)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def load(spark, db, *changes, **options):
    return publish.publish_month(spark, db, arrivals(spark, *changes), lookups(spark), **options)


MARCH = {"i94mon": 3.0, "arrdate": 20520.0}
NO_DAY = {"arrdate": None}


def kept(spark, db):
    return rows(spark.table(f"{db}.visit_keys").select("admission_id", "arrival_month", "year_month"))


# ---- key index ------------------------------------------------------------


def test_keys_follow_replace_and_append(spark, db):
    load(spark, db, {}, {"admnum": 2.0} | NO_DAY, {"admnum": 3.0} | MARCH)
    assert kept(spark, db) == [(1, 201602, 201602), (2, 196001, 201602), (3, 201603, 201603)]
    load(spark, db, {"admnum": 4.0})  # February has no missing day any more
    assert kept(spark, db) == [(3, 201603, 201603), (4, 201602, 201602)]
    load(spark, db, {"admnum": 5.0}, mode="append")
    assert kept(spark, db) == [(3, 201603, 201603), (4, 201602, 201602), (5, 201602, 201602)]


@pytest.mark.parametrize("buckets", [None, 2])
def test_no_published_row_is_read(spark, buckets):
    db = new_warehouse(spark, buckets)
    load(spark, db, {}, {"admnum": 2.0} | NO_DAY)
    for table in ("visitor_analysis", "visitors"):
        for file in spark.table(f"{db}.{table}").inputFiles():
            with open(urlparse(file).path, "wb") as broken:
                broken.write(b"no parquet")
    load(spark, db, {"admnum": 3.0} | MARCH)
    load(spark, db, {"admnum": 4.0} | MARCH, mode="append")
    for again in ({}, {"admnum": 2.0} | NO_DAY):
        with pytest.raises(QualityError, match="new_key"):
            load(spark, db, again | {"i94mon": 3.0})
        with pytest.raises(QualityError, match=r"new_key.* = 1, first \d,(2016-02-01|1960-01-01)"):
            load(spark, db, again, mode="append")
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_only_months_of_arrival_of_the_batch_are_read(spark, db):
    load(spark, db, {}, {"admnum": 2.0} | MARCH)
    index = spark.table(f"{db}.visit_keys")
    seen = []
    fact = star.visit_fact(star.build_visits(arrivals(spark, {"admnum": 9.0}), lookups(spark)))
    report = quality.collision_report(fact, index, schemas.VISITOR_ANALYSIS)
    plan = report._jdf.queryExecution().toString()
    seen += [line for line in plan.splitlines() if "PartitionFilters" in line and "arrival_month" in line]
    assert seen and "201602" in seen[0] and "201603" not in seen[0]


def test_many_keys_are_merged_however_small_their_files(spark, tmp_path):
    """Spark takes a column of compressed files for small, though it has millions of rows."""
    many = spark.range(quality.MOST_BROADCAST_KEYS + 1).select(
        F.col("id").alias("admission_id"),
        F.expr("DATE '2016-02-01'").alias("arrival_date"),
        F.lit(201602).alias("year_month"),
    )
    many.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    held = (F.lit(True).alias("in_visitor_analysis"), F.lit(201602).alias("arrival_month"))
    index = many.filter("admission_id % 2 = 0").select("*", *held)
    report = quality.collision_report(fact, index, schemas.VISITOR_ANALYSIS)
    assert "BroadcastHashJoin" not in plan(report)
    assert report.first().value == quality.MOST_BROADCAST_KEYS // 2 + 1
    few = quality.collision_report(fact.filter("admission_id < 3"), index, schemas.VISITOR_ANALYSIS)
    assert few.first().value == 2


def test_index_is_rebuilt_from_published_tables(spark, db):
    load(spark, db, {}, {"admnum": 2.0} | NO_DAY, {"admnum": 3.0} | MARCH)
    before, visits = kept(spark, db), rows(spark.table(f"{db}.date_visits"))
    name = f"{db}.visit_keys"
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (year_month=201603, arrival_month=201603)")
    publish.rebuild_kept(spark, db)
    assert kept(spark, db) == before and rows(spark.table(f"{db}.date_visits")) == visits
    with pytest.raises(QualityError, match="new_key"):
        load(spark, db, {"admnum": 3.0, "arrdate": 20520.0})


def test_tables_handed_over_apart_are_indexed_apart(spark, db):
    visits = star.build_visits(arrivals(spark, {}, {"admnum": 2.0}), lookups(spark))
    fact, visitors = star.visit_fact(visits), star.visitor_dim(visits.filter("admission_id = 1"))
    dates = star.arrival_date_dim(visits)
    publish.publish_batch(spark, db, publish.Batch(fact, visitors, dates))
    flags = spark.table(f"{db}.visit_keys").select("admission_id", "in_visitor_analysis", "in_visitors")
    assert rows(flags) == [(1, True, True), (2, True, False)]
    moved = visitors.withColumn("admission_id", F.lit(2).cast("long"))
    other = fact.withColumn("admission_id", F.col("admission_id") + 10)
    publish.publish_batch(spark, db, publish.Batch(other, moved, dates), mode="append")
    with pytest.raises(QualityError, match="visitors: new_key"):
        publish.publish_batch(spark, db, publish.Batch(other, moved, dates), mode="append")
    march = visitors.withColumn("year_month", F.lit(201603))
    with pytest.raises(QualityError, match="differ in months"):
        publish.publish_batch(spark, db, publish.Batch(fact, march, dates))


# ---- dates ----------------------------------------------------------------


def test_dates_leave_with_their_last_visit(spark, db):
    def dates():
        return [str(r[0]) for r in rows(spark.table(f"{db}.arrival_date").select("arrival_date"))]

    load(spark, db, {}, {"admnum": 2.0} | NO_DAY, {"admnum": 3.0} | MARCH | NO_DAY)
    assert dates() == ["1960-01-01", "2016-02-01"]
    load(spark, db, {"admnum": 4.0, "arrdate": 20486.0})
    assert dates() == ["1960-01-01", "2016-02-02"]  # March still has a missing day
    load(spark, db, {"admnum": 3.0} | MARCH)
    assert dates() == ["2016-02-02", "2016-03-07"]
    load(spark, db, {"admnum": 5.0}, mode="append")
    counts = spark.table(f"{db}.date_visits").groupBy("arrival_date").agg(F.sum("visits"))
    assert dates() == [str(r[0]) for r in rows(counts)] and {r[1] for r in counts.collect()} == {1}


# ---- stage ----------------------------------------------------------------


def test_batches_are_staged_at_once_and_published_one_by_one(spark, db):
    months = {"feb": {}, "mar": MARCH, "apr": {"i94mon": 4.0, "arrdate": 20550.0}}
    visits = {
        name: star.build_visits(arrivals(spark, change, change | {"admnum": 2.0}), lookups(spark))
        for name, change in months.items()
    }
    with ThreadPoolExecutor(3) as pool:
        staged = pool.map(lambda n: publish.stage_visits(spark, db, visits[n], True, n), visits)
        batches = dict(zip(visits, staged, strict=True))
    assert publish.staged_names(spark, db) == ["apr", "feb", "mar"]
    publish.publish_batch(spark, db, batches["mar"])
    assert kept(spark, db) == [(1, 201603, 201603), (2, 201603, 201603)]
    publish.stage_visits(spark, db, visits["feb"].filter("admission_id = 2"), name="feb")
    publish.publish_batch(spark, db, publish.staged_batch(spark, db, "feb"))
    assert len(kept(spark, db)) == 3
    for name in ("feb", "mar", "feb"):
        publish.release(spark, db, name)
    assert publish.staged_names(spark, db) == ["apr"]
    assert publish.staged_batch(spark, db, "apr").fact.count() == 2


def test_a_stage_without_rows_has_none_of_before(spark, db):
    load(spark, db, {})
    with pytest.raises(QualityError, match="row_count"):
        load(spark, db, {"admnum": None})
    for name in ("", "a/b", "../x", "a=b"):
        with pytest.raises(ValueError):
            publish.staged_batch(spark, db, name)


# ---- what a load counts -----------------------------------------------------


def test_a_load_says_what_became_of_its_records(spark, db):
    changes = [{}, {}, {"admnum": 2.0, "i94bir": 1e12}, {"admnum": 3e20}, {"admnum": None}, {"admnum": 4.0, "biryear": float("nan")}]
    counts = load(spark, db, *changes)
    assert (counts.read, counts.without_id, counts.copies, counts.staged) == (6, 2, 1, 3)
    assert {k: n for k, n in counts.rejected.items() if n} == {"admnum": 1, "i94bir": 1, "biryear": 1}


def test_text_that_is_no_number_is_counted(spark, db, tmp_path):
    path = str(tmp_path / "text")
    typed = arrivals(spark, {}, {"admnum": 2.0}, {"admnum": 3.0})
    as_text = typed.select(*(F.col(c).cast("string").alias(c) for c in typed.columns))
    abc = F.when(F.col("admnum") == "3.0", "abc").otherwise(F.col("admnum"))
    as_text.withColumn("admnum", abc).withColumn("i94mode", F.lit("by air")).write.csv(path, header=True)
    raw = readers.read_arrivals(spark, path, "csv", as_text=True)
    counts = publish.publish_month(spark, db, raw, lookups(spark))
    assert counts.rejected["admnum"] == 1 and counts.rejected["i94mode"] == 3
    assert (counts.read, counts.without_id, counts.staged) == (3, 1, 2)
    plain = star.build_visits(readers.read_arrivals(spark, path, "csv"), lookups(spark))
    assert rows(plain) == rows(star.build_visits(raw, lookups(spark)))


def test_too_many_rejected_values_are_refused_and_stay_staged(spark, db):
    bad = [{"admnum": float(i), "i94bir": 1e12} for i in range(1, 4)]
    with pytest.raises(QualityError, match=r"rejected\(i94bir\) = 3"):
        load(spark, db, *bad, max_rejected=2)
    assert kept(spark, db) == [] and publish.staged_batch(spark, db).fact.count() == 3
    assert load(spark, db, *bad, max_rejected=3).rejected["i94bir"] == 3


def test_a_load_of_nothing_is_counted_too(spark, db):
    watch = quality.LoadWatch()
    raw = arrivals(spark, {"admnum": None}, {"admnum": None, "i94yr": 1e12})
    visits = watch.rows(star.build_visits(watch.raw(raw), lookups(spark)))
    publish.stage_visits(spark, db, visits)
    counts = watch.counts()
    assert (counts.read, counts.without_id, counts.copies, counts.staged) == (2, 2, 0, 0)
    assert counts.rejected["i94yr"] == 1


# ---- files, keys, digests ---------------------------------------------------


@pytest.mark.parametrize("first", [["gender", "i94visa"], []])
def test_every_file_of_a_folder_must_have_all_columns(spark, tmp_path, first):
    path = str(tmp_path / "mixed")
    whole = arrivals(spark, {}).coalesce(1)
    for lacking in (first, [c for c in ("gender", "i94visa") if c not in first]):
        whole.drop(*lacking).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match=r"lacks \['i94visa', 'gender'\]"):
        readers.read_arrivals(spark, path)
    layouts = {len(r["columns"]): (r["files"], r["rows"]) for r in readers.parquet_layouts(spark, path).collect()}
    assert layouts == {13: (1, 1), 15: (1, 1)}
    more = str(tmp_path / "more")
    whole.withColumn("extra", F.lit(1)).write.parquet(more)
    assert readers.read_arrivals(spark, more).count() == 1


PAIR = schemas.Table("pair", (schemas.Column("a", "INT", True), schemas.Column("b", "STRING")), ("a", "b"))


@pytest.mark.parametrize("slices", [1, 7])
def test_reports_name_the_first_keys_at_fault(spark, slices):
    data = [(i, f"k{i % 3}") for i in range(40)] + [(i, f"k{i % 3}") for i in (30, 9, 21, 9)] + [(None, "x"), (None, "x"), (None, None)]
    frame = spark.createDataFrame(data, "a int, b string").repartition(slices)
    report = {r.check_name: (r.value, r["keys"]) for r in quality.table_report(frame, PAIR, sample=3).collect()}
    assert report["unique_key"] == (5, ["null,x", "9,k0", "21,k0"])
    assert report["required"] == (3, ["null,null", "null,x"])
    assert report["row_count"] == (47, [])
    with pytest.raises(QualityError, match=r"unique_key\(a,b\) = 5, first null,x; 9,k0; 21,k0; 30,k0"):
        quality.gate_batch([(frame, PAIR)])
    without = quality.table_report(frame, PAIR, ("required",), sample=1).collect()
    assert [(r.value, r["keys"]) for r in without] == [(3, ["null,null"])]


def test_distinct_by_digest(spark, monkeypatch):
    changes = [{}, {}, {"gender": None}, {"gender": None}, {"visatype": None}, {"admnum": None}]
    raw = clean.type_arrivals(arrivals(spark, *changes)).withColumn("_digest", F.lit(1)).repartition(3)
    want = rows(raw.dropDuplicates())
    got = clean.distinct_rows_by_digest(raw)
    assert got.columns == raw.columns and rows(got) == want and len(want) == 4
    assert rows(clean.distinct_rows_by_digest(raw, max_repeated=0)) == want
    # One digest for all: all rows are compared as a whole.
    monkeypatch.setattr(clean.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    assert rows(clean.distinct_rows_by_digest(raw)) == want


# ---- work of the driver ---------------------------------------------------


def jobs_of(spark, work):
    """How many Spark jobs that takes."""
    context, group = spark.sparkContext, uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_partitions_and_buckets_are_told_without_a_job(spark, db):
    load(spark, db, {}, {"admnum": 2.0} | MARCH)
    index = f"{db}.{schemas.VISIT_KEYS.name}"
    assert jobs_of(spark, lambda: tables.bucket_count(spark, db, schemas.VISITORS)) == 0
    assert jobs_of(spark, lambda: tables.partitions(spark, index)) == 0
    assert [p["year_month"] for p in tables.partitions(spark, index)] == ["201602", "201603"]


@pytest.mark.parametrize("mode", ["replace", "append"])
def test_a_batch_of_new_months_reads_no_key_index(spark, db, mode):
    load(spark, db, {})
    for file in spark.table(f"{db}.visit_keys").inputFiles():
        with open(urlparse(file).path, "wb") as broken:
            broken.write(b"no parquet")
    load(spark, db, {"admnum": 2.0} | MARCH, mode=mode)
    assert rows(spark.table(f"{db}.visitor_analysis").select("admission_id")) == [(1,), (2,)]


def test_a_publish_takes_few_jobs(spark, db):
    """Each job, and each stage, has the driver make broadcasts of several MB."""
    visits = star.build_visits(arrivals(spark, {}, {"admnum": 2.0} | MARCH), lookups(spark))
    batch = publish.stage_visits(spark, db, visits)
    assert jobs_of(spark, lambda: publish.publish_batch(spark, db, batch)) <= 24  # once 35

from __future__ import annotations

import datetime
import json
from types import SimpleNamespace

import pytest
from helpers import ARRIVAL, arrivals, plan, rows

from arrivals_engine import schemas
from arrivals_engine.operators.clean import clean_arrivals
from arrivals_engine.sources import readers, tables
from arrivals_engine.sources.scratch import scratch_path


def test_lookup_cells_are_trimmed_and_blanks_are_null(spark, tmp_path):
    path = tmp_path / "ports.csv"
    path.write_text(
        "port_code,port_city,port_state_code\n"
        '  NYC ,  NEW YORK,NY  \nSEA,   ,WA\nPDX," ",OR\n007,"A, B",\n'
    )
    found = readers.read_lookup(spark, str(path), schemas.PORT_COLUMNS)
    assert {t for _, t in found.dtypes} == {"string"}
    assert rows(found) == [
        ("007", "A, B", None),
        ("NYC", "NEW YORK", "NY"),
        ("PDX", " ", "OR"),
        ("SEA", None, "WA"),
    ]


def test_lookup_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "ports.csv"
    path.write_text("extra,port_state_code,port_code,port_city\n1,NY,NYC,NEW YORK\n")
    found = readers.read_lookup(spark, str(path), schemas.PORT_COLUMNS)
    assert rows(found) == [("NYC", "NEW YORK", "NY")]


def test_missing_lookup_column_is_an_error(spark, tmp_path):
    path = tmp_path / "ports.csv"
    path.write_text("port_code,port_city\nNYC,NEW YORK\n")
    with pytest.raises(Exception, match="port_state_code"):
        readers.read_lookup(spark, str(path), schemas.PORT_COLUMNS)


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_arrivals_come_back_from_files(spark, tmp_path, file_format):
    path = str(tmp_path / "month")
    raw = arrivals(spark, {}, {"admnum": 2.0, "gender": None, "arrdate": None, "i94port": "007"})
    writer = raw.selectExpr("1 AS unused", "*").write
    writer.parquet(path) if file_format == "parquet" else writer.csv(path, header=True)
    found = readers.read_arrivals(spark, path, file_format)
    assert found.columns == list(ARRIVAL)
    assert rows(clean_arrivals(found)) == rows(clean_arrivals(raw))


def test_parquet_scan_reads_only_used_columns(spark, tmp_path):
    path = str(tmp_path / "month")
    arrivals(spark, {}).selectExpr("1 AS unused", "*").write.parquet(path)
    assert "unused" not in plan(clean_arrivals(readers.read_arrivals(spark, path)))


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        readers.read_arrivals(spark, "x", "sas")


def demographics_file(directory, **fields):
    directory.mkdir()
    record = {"datasetid": "d", "recordid": "r", "record_timestamp": "t", "fields": fields}
    (directory / "a.json").write_text(json.dumps(record) + "\n")
    return str(directory)


def test_absent_demographic_fields_are_null(spark, tmp_path):
    path = demographics_file(tmp_path / "demo", city="SEATTLE", count=3, median_age=33)
    fields = readers.read_demographics(spark, path).first().fields
    assert (fields.city, fields["count"], fields.median_age) == ("SEATTLE", 3, 33.0)
    assert fields.race is None


def test_demographics_of_another_type_are_an_error(spark, tmp_path):
    path = demographics_file(tmp_path / "demo", city="SEATTLE", count="many")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_demographics(spark, path).collect()


def json_dir(directory, *records):
    directory.mkdir()
    (directory / "a.json").write_text("\n".join(json.dumps(r) for r in records))
    return str(directory)


def test_json_fields_are_matched_by_name_and_text_is_converted(spark, tmp_path):
    path = json_dir(
        tmp_path / "fact",
        {"year_month": "201602", "arrival_date": "2016-02-01", "admission_id": 12, "other": 1},
        {"year_month": 201603, "admission_id": "13", "port_city": "A"},
    )
    found = readers.read_typed_json(spark, path, schemas.VISITOR_ANALYSIS)
    assert found.columns == schemas.VISITOR_ANALYSIS.names
    first, second = found.orderBy("admission_id").collect()
    assert first.arrival_date == datetime.date(2016, 2, 1)
    assert (first.admission_id, first.year_month, first.port_city) == (12, 201602, None)
    assert (second.admission_id, second.year_month, second.arrival_date) == (13, 201603, None)


@pytest.mark.parametrize(
    "record", [{"admission_id": "x"}, {"arrival_date": "soon"}, {"year_month": 3_000_000_000}]
)
def test_json_values_that_do_not_convert_are_an_error(spark, tmp_path, record):
    path = json_dir(tmp_path / "fact", record)
    with pytest.raises(Exception, match="is no (BIGINT|DATE|INT)"):
        readers.read_typed_json(spark, path, schemas.VISITOR_ANALYSIS).collect()


def test_written_json_leaves_out_nulls_and_is_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_json(spark.range(5), path)
    tables.write_json(spark.createDataFrame([(1, None)], "a int, b string"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ['{"a":1}']


def session(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: settings.get("folder", default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_paths_are_fresh_and_in_the_shared_folder():
    cluster = session("yarn", folder="hdfs://shared/place/")
    one, two = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert one.startswith("hdfs://shared/place/x_")
    assert one != two


def test_scratch_is_in_a_folder_that_executors_share(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert scratch_path(spark, "x").startswith(f"{base}/x_")


def test_typed_json_is_as_strict_without_ansi(spark, tmp_path):
    path = json_dir(tmp_path / "fact", {"admission_id": "x"})
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="is no BIGINT"):
            readers.read_typed_json(spark, path, schemas.VISITOR_ANALYSIS).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_lookup_files_of_another_column_order_are_refused(spark, tmp_path):
    for name, text in (("a", "port_code,port_city\nSEA,SEATTLE\n"), ("b", "port_city,port_code\nNEW YORK,NYC\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="header"):
        readers.read_lookup(spark, str(tmp_path), ("port_code", "port_city")).collect()


def test_arrivals_that_lack_a_column_are_refused(spark, tmp_path):
    path = str(tmp_path / "arrivals")
    spark.range(3).selectExpr("CAST(id AS DOUBLE) AS admnum").write.parquet(path)
    with pytest.raises(ValueError, match="gender"):
        readers.read_arrivals(spark, path)


def test_a_failed_refresh_leaves_the_tables_as_they_were(spark, tmp_path):
    db = "refresh_fails"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}'")
    spark.sql(f"CREATE TABLE {db}.one (a INT) USING parquet")
    spark.sql(f"CREATE TABLE {db}.two (a INT) USING parquet")
    good = spark.createDataFrame([(1,)], "a int")
    tables.replace_whole(spark, {f"{db}.one": good, f"{db}.two": good})
    failing = good.selectExpr("CAST(raise_error('lost') AS INT) AS a")
    with pytest.raises(Exception, match="lost"):
        tables.replace_whole(spark, {f"{db}.one": good.selectExpr("a + 1 AS a"), f"{db}.two": failing})
    assert spark.table(f"{db}.one").collect() == spark.table(f"{db}.two").collect() == good.collect()
    spark.sql(f"DROP DATABASE {db} CASCADE")

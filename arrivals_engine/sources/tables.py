"""JSON output, and the tables of the warehouse: create, drop, load."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_engine import schemas
from arrivals_engine.functions.dates import CALENDAR
from arrivals_engine.sources.scratch import scratch_path

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines, replacing what is there. Null fields are left out."""
    rows.write.mode("overwrite").json(path)


def _create_table(spark: SparkSession, db: str, table: schemas.Table, buckets: int | None) -> None:
    ddl = f"CREATE TABLE {db}.{table.name} ({', '.join(c.ddl for c in table.columns)}) USING parquet"
    if table.partitions:
        ddl += f" PARTITIONED BY ({', '.join(table.partitions)})"
    if buckets:
        ddl += f" CLUSTERED BY ({', '.join(table.key)}) INTO {buckets} BUCKETS"
    spark.sql(ddl)


def create_tables(spark: SparkSession, db: str, buckets: int | None = None) -> None:
    """All tables and staging views, empty.

    With `buckets`, fact, visitors and their key index are bucketed by their common key, so
    that joining them does not shuffle; publishing then shuffles each of them once.
    """
    for table in schemas.FINAL_TABLES + schemas.KEPT_TABLES:
        bucketed = table.key == schemas.VISIT_KEY
        _create_table(spark, db, table, buckets if bucketed else None)
    for table in schemas.STAGE_TABLES:
        _create_table(spark, db, table, None)
    staged = f"{db}.{schemas.STAGE_VISITS.name}"
    for view, table in schemas.STAGE_VIEWS.items():
        if table is schemas.ARRIVAL_DATE:
            parts = ", ".join(f"{f}(arrival_date) AS {name}" for name, f in CALENDAR.items())
            query = f"SELECT arrival_date, {parts} FROM (SELECT DISTINCT arrival_date FROM {staged})"
        else:
            query = f"SELECT {', '.join(table.names)} FROM {staged}"
        spark.sql(f"CREATE VIEW {db}.{view} AS {query}")


def drop_tables(spark: SparkSession, db: str) -> None:
    for view in schemas.STAGE_VIEWS:
        spark.sql(f"DROP VIEW IF EXISTS {db}.{view}")
    for table in schemas.STAGE_TABLES + schemas.FINAL_TABLES + schemas.KEPT_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{table.name}")


def bucket_count(spark: SparkSession, db: str, table: schemas.Table) -> int | None:
    # A filter on the lines would make a Spark job of it.
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{table.name}").collect()
    found = [int(r["data_type"]) for r in described if r["col_name"] == "Num Buckets"]
    return found[0] if found and found[0] > 0 else None


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """Table inserts take this from the session only, not from a write option."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _in_table_order(spark: SparkSession, rows: DataFrame, full_name: str) -> DataFrame:
    return rows.select(*spark.table(full_name).columns)


def append_rows(spark: SparkSession, rows: DataFrame, full_name: str) -> None:
    _in_table_order(spark, rows, full_name).write.mode("append").insertInto(full_name)


def replace_whole(spark: SparkSession, new: dict[str, DataFrame]) -> None:
    """The rows of several tables (by full name) anew. All are written to fresh folders
    first; then each table is pointed to its new one. A write that fails leaves every table
    as it was. The switches are quick but one after another, so a reader in between may see
    one table of before and one of after. Old folders stay for readers that are still on
    them."""
    paths = {}
    for name, rows in new.items():
        wanted = spark.table(name).schema
        paths[name] = scratch_path(spark, name.rpartition(".")[2])
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted]
        rows.select(*typed).write.parquet(paths[name])
    for name, path in paths.items():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)


def partitions(spark: SparkSession, full_name: str) -> list[dict[str, str]]:
    """The partitions of a table, each as its values by column, told without a job."""
    shown = spark.sql(f"SHOW PARTITIONS {full_name}").collect()
    return [dict(part.split("=", 1) for part in row[0].split("/")) for row in shown]


def drop_listed(spark: SparkSession, full_name: str, listed: list[dict[str, str]]) -> None:
    """These of the partitions of a table."""
    if listed:
        specs = [", ".join(f"{name}='{value}'" for name, value in spec.items()) for spec in listed]
        dropped = ", ".join(f"PARTITION ({spec})" for spec in specs)
        spark.sql(f"ALTER TABLE {full_name} DROP IF EXISTS {dropped}")


def drop_partitions(spark: SparkSession, full_name: str, **values: list) -> None:
    """The partitions of a table that have one of the values in each of the given columns."""
    wanted = {name: {str(v) for v in some} for name, some in values.items()}
    listed = [
        spec
        for spec in partitions(spark, full_name)
        if all(spec[name] in some for name, some in wanted.items())
    ]
    drop_listed(spark, full_name, listed)


def replace_rows(spark: SparkSession, rows: DataFrame, full_name: str) -> None:
    """The whole table anew, for staging: the rows of before go first, so a write that fails
    leaves the table empty."""
    with _overwriting(spark, "static"):
        _in_table_order(spark, rows, full_name).write.mode("overwrite").insertInto(full_name)


def replace_partitions(spark: SparkSession, rows: DataFrame, full_name: str) -> None:
    """Only those partitions anew that the rows fall in."""
    with _overwriting(spark, "dynamic"):
        _in_table_order(spark, rows, full_name).write.mode("overwrite").insertInto(full_name)

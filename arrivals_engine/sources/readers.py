"""Input readers. Schemas are given, so no pass over the data infers them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_engine import schemas


def _header_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as trimmed text, named by the header of one file; a file whose header
    differs, be it in the order only, is an error when it is read."""
    how = {"header": True, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    names = spark.read.csv(path, **how).columns
    schema = ", ".join(f"`{name}` STRING" for name in names)
    return spark.read.schema(schema).csv(path, enforceSchema=False, **how)


def read_lookup(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A code lookup. Columns are found by name; a missing one is an error."""
    return _header_csv(spark, path).select(*columns)


def parquet_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(columns, files, rows, example): the column lists of the Parquet files of a folder, how
    many files and rows have each, and the first file. Footers are read in tasks, some files to each; the
    files' names are all that the driver holds. Files are opened with pyarrow.fs, which has
    file, hdfs, s3, gs and abfs addresses."""

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for file in batch["file"]:
                system, at = FileSystem.from_uri(file)
                with system.open_input_file(at) as opened:
                    footer = pq.ParquetFile(opened)
                    names, rows = sorted(footer.schema_arrow.names), footer.metadata.num_rows
                found.append((names, rows, file))
            yield pd.DataFrame(found, columns=["columns", "rows", "file"])

    files = spark.read.option("mergeSchema", "false").parquet(path).inputFiles()
    slices = max(1, min(len(files) // 32, 1000))
    names = spark.createDataFrame([(f,) for f in files], "file string").repartition(slices)
    layouts = names.mapInPandas(footers, "columns array<string>, rows long, file string")
    return layouts.groupBy("columns").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min("file").alias("example")
    )


def _check_layouts(spark: SparkSession, path: str) -> None:
    wanted = F.array(*(F.lit(name) for name, _, _ in schemas.ARRIVAL_COLUMNS))
    short = parquet_layouts(spark, path).withColumn("lacks", F.array_except(wanted, "columns"))
    worst = short.filter(F.size("lacks") > 0).orderBy("example").limit(3).collect()
    if worst:
        found = "; ".join(f"{r['example']} and {r['files'] - 1} more lack {r['lacks']}" for r in worst)
        raise ValueError(found.replace(" and 0 more lack", " lacks"))


def read_arrivals(
    spark: SparkSession, path: str, file_format: str = "parquet", as_text: bool = False
) -> DataFrame:
    """One month's arrival records, from Parquet or from CSV with a header. A column that
    is not there is an error, whichever file of a folder lacks it. CSV numbers come typed, or
    with `as_text` as they are written, so that those of no number can be counted."""
    if file_format == "parquet":
        _check_layouts(spark, path)
        return spark.read.schema(schemas.ARRIVALS_RAW).parquet(path)
    if file_format == "csv":
        rows = _header_csv(spark, path)
        if as_text:
            return rows.select(*(n for n, _, _ in schemas.ARRIVAL_COLUMNS))
        return rows.select(
            *(F.col(n).try_cast(raw).alias(n) for n, raw, _ in schemas.ARRIVAL_COLUMNS)
        )
    raise ValueError(f"arrivals come as parquet or csv, not {file_format!r}")


def read_demographics(spark: SparkSession, path: str) -> DataFrame:
    """A directory of nested JSON records. A value of another type is an error."""
    return spark.read.schema(schemas.DEMOGRAPHICS_RAW).json(path, mode="FAILFAST")


def read_typed_json(spark: SparkSession, path: str, table: schemas.Table) -> DataFrame:
    """JSON lines in the types of a table. Fields are matched by name and may be
    numbers or text ("201602"); a value that its type cannot hold is an error, whatever
    the session's ANSI setting."""
    as_text = ", ".join(f"`{name}` STRING" for name in table.names)
    rows = spark.read.schema(as_text).json(path, mode="FAILFAST")
    return rows.select(*(_typed(c).alias(c.name) for c in table.columns))


def _typed(column: schemas.Column) -> Column:
    text = F.col(column.name)
    value = text.try_cast(column.frame_type)
    wrong = F.concat(F.lit(f"{column.name} is no {column.frame_type}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(wrong)).otherwise(value)

"""Where intermediate data may be written."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that the session names in spark.checkpoint.dir, or else
    in its warehouse; all executors share both."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}_{uuid4().hex}"

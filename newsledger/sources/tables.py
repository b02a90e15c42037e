"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A Parquet table, only the named columns when some are named."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table

"""Stored pages as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAGES = "page_id bigint, url string, final_url string, html string"


def pages_source(spark: SparkSession, path: str, file_format: str = "parquet", **options) -> DataFrame:
    """Fetched pages ``(page_id, url, html)``, with ``final_url`` where redirects were recorded.

    Parquet and ORC bring their own schema and are read column by column as needed; for JSON and CSV
    the schema is given, so nothing is read to infer it.
    """
    reader = spark.read.format(file_format).options(**options)
    if file_format in ("json", "csv"):
        reader = reader.schema(PAGES)
    pages = reader.load(path)
    missing = {"page_id", "url", "html"} - set(pages.columns)
    if missing:
        raise ValueError(f"pages at {path} lack {sorted(missing)}")
    return pages

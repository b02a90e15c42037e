"""Tables of the engine derived from the supplied ones, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.functions.urls import dedup_key
from newsledger.sources.tables import read_table

EPOCH = 1704067200  # 2024-01-01


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{table}.parquet")


def documents_as_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an item: first line as title, language as category, one minute apart."""
    docs = read(spark, sf_dir, "documents")
    title = F.substring_index("text", "\n", 1)
    url = F.concat(F.lit("https://www.example.org/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    defaults = S.item_defaults()
    return docs.select(
        "doc_id",
        "source",
        title.alias("title"),
        F.col("lang").alias("category"),
        F.substring("text", 1, S.SUMMARY_CHARS).alias("summary"),
        F.col("text").alias("body"),
        url.alias("url"),
        F.timestamp_seconds(F.lit(EPOCH) + F.col("doc_id") * 60).alias("published_at"),
        (F.lit(1) + F.least(F.lit(9), F.floor(F.col("n_chars") / 1000))).cast("short").alias("importance"),
        dedup_key(url, title).alias("dedup_key"),
        F.lit(False).alias("is_analyzed"),
        F.lit(0.0).alias("sentiment_score"),
        defaults["tags"].alias("tags"),
        defaults["entities"].alias("entities"),
        F.lit("").alias("ai_summary"),
        F.lit(None).cast("string").alias("pipeline_run_id"),
    )


ITEMS_SQL = f"""
items AS (
  SELECT *, sha256(url || title) AS dedup_key FROM (
    SELECT doc_id, source, split_part(text, chr(10), 1) AS title, lang AS category,
           substr(text, 1, {S.SUMMARY_CHARS}) AS summary, text AS body,
           'https://www.example.org/' || source || '/' || doc_id AS url,
           {EPOCH} + doc_id * 60 AS published_epoch,
           1 + least(9, n_chars // 1000) AS importance
    FROM documents))
"""

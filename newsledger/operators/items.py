"""The item record: building, projecting, combining."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.functions.urls import dedup_key


def with_dedup_key(df: DataFrame) -> DataFrame:
    return df.withColumn("dedup_key", dedup_key(F.col("url"), F.col("title")))


def to_items(
    entries: DataFrame, run_id: Column | str | None = None, published_at: Column | None = None
) -> DataFrame:
    """Items from ``(source, title, url, body)``; other columns are dropped.

    The summary is the first 600 characters of the body, the time of publication is the time of
    collection unless given.
    """
    run = run_id if isinstance(run_id, Column) else F.lit(run_id).cast("string")
    defaults = S.item_defaults()
    return entries.select(
        defaults["id"].alias("id"),
        "source",
        "title",
        F.lit(S.SCRAPE_CATEGORY).alias("category"),
        F.substring("body", 1, S.SUMMARY_CHARS).alias("summary"),
        "body",
        "url",
        (F.current_timestamp() if published_at is None else published_at).alias("published_at"),
        defaults["importance"].alias("importance"),
        defaults["target_roles"].alias("target_roles"),
        dedup_key(F.col("url"), F.col("title")).alias("dedup_key"),
        defaults["is_analyzed"].alias("is_analyzed"),
        defaults["sentiment_score"].alias("sentiment_score"),
        defaults["tags"].alias("tags"),
        defaults["entities"].alias("entities"),
        F.lit("").alias("ai_summary"),
        run.alias("pipeline_run_id"),
    )


def to_record(items: DataFrame) -> DataFrame:
    """The 17-field record; time as ISO-8601 text with UTC offset."""
    iso = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format("published_at", "SSSSSS")
    text = F.concat(
        iso,
        F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
        F.date_format("published_at", "xxx"),
    )
    run = F.when(F.col("pipeline_run_id") == "", None).otherwise(F.col("pipeline_run_id"))
    return items.withColumns({"published_at": text, "pipeline_run_id": run}).select(*S.RECORD_COLUMNS)


def to_record_json(items: DataFrame, column: str = "record") -> DataFrame:
    """One JSON object per item, nulls kept."""
    record = F.to_json(F.struct(*S.RECORD_COLUMNS), {"ignoreNullFields": "false"})
    return to_record(items).select("dedup_key", record.alias(column))


def safe_columns(df: DataFrame) -> DataFrame:
    """Only the columns which may be written."""
    return df.select([c for c in df.columns if c in S.SAFE_COLUMNS])


def union_sources(*sources: DataFrame) -> DataFrame:
    """All items of all sources, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), sources)

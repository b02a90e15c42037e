"""Helpers of this subpackage: tables in the shared folder, input columns, held-out rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names.

    Only a local session may go without that setting; it then gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="newsledger-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once and kept as a table in the shared folder: lineage ends there, lost executors cost nothing."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty, whatever other columns ``docs`` has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def fold(parts: int, doc_id: str = "doc_id") -> Column:
    """The remainder of the id's crc32 (0 for a null id): which part of a split a row belongs to."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts, F.lit(0)).cast("int")


_kept: dict = {}


def kept_by_worker(key: tuple, make):
    """``make()``, kept for later tasks of this Python worker under ``key``; a worker keeps one such thing, so stages that follow each other do not add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release_worker() -> None:
    """Drops what this Python worker keeps for other operators."""
    _kept.clear()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")

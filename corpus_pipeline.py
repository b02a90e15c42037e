"""From ``documents`` to packed training sequences: quality, toxicity, exact and near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. The first four keep rows and columns of documents; the last gives the parts of documents with their place in a sequence.

The two classifiers learn from the labelled rows of the tables in ``sf_dir`` (bounded samples, see their settings) and are applied
to every row that the stage gets. Of equal texts the row with the largest id stays, of similar ones that with the smallest.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from newsledger.llm import exact, minhash, packing, quality, toxicity
from newsledger.llm.chunks import WORD_BPE, vocabulary
from newsledger.llm.shared import documents, labels, stored
from newsledger.session import ship_packages

# No SQL says what the classifiers learn: tests compare the stages with plain versions.
ORACLE_SQL = None


def _ship(spark: SparkSession) -> None:
    ship_packages(spark, Path(__file__).resolve().parent / "newsledger")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ship(spark)
    return quality.keep_good(docs, quality.train(documents(spark, sf_dir), labels(spark, sf_dir)))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ship(spark)
    return toxicity.keep_clean(docs, toxicity.train(documents(spark, sf_dir), labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ship(spark)
    return exact.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ship(spark)
    return minhash.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ship(spark)
    return packing.pack(docs, vocabulary(WORD_BPE)).drop("shard", "row")


STAGES = [
    ("quality", keep_good),
    ("toxicity", keep_clean),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

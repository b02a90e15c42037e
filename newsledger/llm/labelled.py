"""Labelled documents to learn from: a bounded, deterministic sample, never from the held-out part."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger.llm.shared import fold, texts_of


def training_rows(labels: DataFrame, column: str, parts: int, held_out: int, per_class: int) -> tuple[DataFrame, float]:
    """``doc_id`` and ``y`` of at most ``per_class`` rows per class, and the log odds of class 1 among all that may be used.

    A document with several labels counts once, as 1 if any is 1; rows without id or label are left out. The choice goes by a hash of the id.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).filter(fold(parts) != held_out)
    rows = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(F.col(column)) > 0).cast("int").alias("y"))
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = []
    for y in (0, 1):
        chosen += rows.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    sample = labels.sparkSession.createDataFrame([(r.doc_id, r.y) for r in chosen], "doc_id long, y int")
    return sample, math.log((sizes.get(1, 0) + 1) / (sizes.get(0, 0) + 1))


def sample_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The texts of the sample, which is bounded and so may be broadcast."""
    return texts_of(docs).join(F.broadcast(sample), "doc_id")

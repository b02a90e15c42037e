"""A model's answers as a table by content: equal texts are asked once, in one run and in all later ones.

One folder per client (model and version under a name of the caller's), Parquet written by Spark: the SHA-256 of the text, the answer
or the error, and the run that asked. Failed texts are kept for the run that asked them alone; a later run asks them again. There is
one writer per client at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.session import materialize

# So many keys to ask are a filter on the texts.
FEW_KEYS = 4096
BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.enabled#key": "true", "parquet.bloom.filter.fpp#key": "0.00001"}


class AnswerTable:
    def __init__(self, spark: SparkSession, path: str, client: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/{quote(client, safe='')}"

    def rows(self, answer_type: str = "string") -> DataFrame:
        """``key``, ``answer``, ``error``, ``run``; no rows where no such folder exists. Any other trouble is raised."""
        schema = f"key string, answer {answer_type}, error string, run string"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def ask(self, texts: DataFrame, ask: Callable[[DataFrame], DataFrame], answer_type: str) -> DataFrame:
        """``key``, ``answer``, ``error``, one row per distinct key of ``texts(key, text)``, out of the stored answers.

        ``ask`` gets ``(key, text)`` of those without an answer, each once, and adds ``answer`` and ``error``. Which keys these are is found first,
        among keys alone, and kept: a run with nothing to ask moves no text, one with few to ask filters the texts where they lie. What is asked lies
        in the table before it is read back, so the answers themselves are moved once and not kept a second time.
        """
        run = str(uuid.uuid4())
        have = self.rows(answer_type).filter("error IS NULL").select("key")
        missing = materialize(texts.select("key").distinct().join(have, "key", "left_anti"))
        few = [r.key for r in missing.limit(FEW_KEYS + 1).collect()]
        if few:
            wanted = texts.filter(F.col("key").isin(few)) if len(few) <= FEW_KEYS else texts.join(missing, "key", "left_semi")
            asked = ask(wanted.groupBy("key").agg(F.first("text").alias("text")))
            asked.select("key", "answer", "error", F.lit(run).alias("run")).write.options(**BLOOM).mode("append").parquet(self.path)
        usable = self.rows(answer_type).filter(F.col("error").isNull() | (F.col("run") == run))
        found = usable.join(texts.select("key").distinct(), "key", "left_semi").groupBy("key")
        # An answer before an error, should a key have both.
        first = F.min_by(F.struct("answer", "error"), F.struct(F.col("error").isNotNull(), "run"))
        return found.agg(first.alias("found")).select("key", "found.answer", "found.error")

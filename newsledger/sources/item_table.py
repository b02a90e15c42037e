"""The stored item table: Parquet in a shared folder, partitioned by the hash of the key.

Spark's writer does the work: new rows are appended, and an update overwrites just the partitions that its keys fall into
(dynamic partition overwrite), which are replaced when the job commits. ``dedup_key`` and ``url`` have Bloom filters in every
row group, so looking for some keys (``operators.stored.having``) reads only row groups that may hold them. There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsledger import schema as S
from newsledger.operators.quality import ContractCounts

# Why a model's answer could not be used; kept next to the row it concerns.
ERRORS = ("analysis_error", "embedding_error")
# A filter lets one of 100,000 other keys pass, so looking for thousands of keys at once still skips nearly all row groups.
BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true"} | {
    f"parquet.bloom.filter.{k}#{c}": v for c in ("dedup_key", "url") for k, v in (("enabled", "true"), ("fpp", "0.00001"))
}


class ItemTable:
    """``digits``: a new table gets 16 ** digits partitions (3 for tens of terabytes); a stored one keeps its own."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = S.ITEMS, digits: int = 1):
        self.spark, self.path, self.schema, self.digits = spark, path.rstrip("/"), schema, digits
        errors = [T.StructField(c, T.StringType()) for c in ERRORS]
        self.fields = [*schema.fields, *errors, T.StructField("part", T.StringType())]

    def rows(self) -> DataFrame:
        """All columns; no rows where no such folder exists. Any other trouble is raised."""
        try:
            return self.spark.read.schema(T.StructType(self.fields)).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], T.StructType(self.fields))

    def read(self) -> DataFrame:
        return self.rows().select(*self.schema.names)

    def failed(self) -> DataFrame:
        """Stored rows whose analysis or vector failed, with the reasons."""
        return self.rows().filter(F.coalesce(*ERRORS).isNotNull()).drop("part")

    def part(self, key: str = "dedup_key") -> Column:
        first = self.rows().select("part").first()
        return F.substring(F.lpad(F.hex(F.xxhash64(key)), 16, "0"), 1, len(first.part) if first else self.digits)

    def _write(self, df: DataFrame, part: Column, mode: str, counts: ContractCounts | None = None) -> None:
        known = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.fields[:-1]]
        rows = df.select(*known).withColumn("part", part).hint("rebalance", F.col("part"))
        if counts is not None:
            rows = counts.watch(rows)
        rows.write.options(partitionOverwriteMode="dynamic", **BLOOM).partitionBy("part").mode(mode).parquet(self.path)

    def append(self, df: DataFrame, counts: ContractCounts | None = None) -> None:
        """Adds rows whose keys are not stored; no stored file is rewritten. ``counts`` checks the rows as they are written."""
        self._write(df, self.part(), "append", counts)

    def merge(
        self, incoming: DataFrame, keys: DataFrame, upsert: Callable[[DataFrame, DataFrame], DataFrame], counts: ContractCounts | None = None
    ) -> None:
        """Appends ``incoming`` and replaces the partitions that hold ``keys`` by ``upsert(stored rows, incoming rows)`` of theirs.

        Run again after a failure it gives the same table: rows appended before are then stored keys.
        """
        part = self.part()
        here = [r.part for r in keys.select(part.alias("part")).distinct().collect()]
        self._write(incoming.filter(~part.isin(here)), part, "append", counts)
        stored = self.rows().filter(F.col("part").isin(here)).drop("part")
        self._write(upsert(stored, incoming.filter(part.isin(here))), part, "overwrite", counts)

"""First n rows per group without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_group(
    df: DataFrame, keys: list, order: list[Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows per group in ``order``; ``rank`` names a column for the position.

    Two cuts, whatever ``n``: a group is dealt into as many parts as there are shuffle partitions, by the partition its rows
    come from, and each part is cut to ``n`` rows; then the group is cut. No task gets more than ``n`` rows of a group from
    each part. (Up to n = 1000 Spark also cuts every map task's rows before the first shuffle.)
    """
    name = rank or "__rank"
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    inner = Window.partitionBy(*keys, "__part").orderBy(*order)
    cut = dealt.withColumn("__in_part", F.row_number().over(inner)).filter(F.col("__in_part") <= n).drop("__part", "__in_part")
    outer = Window.partitionBy(*keys).orderBy(*order)
    found = cut.withColumn(name, F.row_number().over(outer)).filter(F.col(name) <= n)
    return found if rank else found.drop(name)

"""Title bigrams as a stored table, so that a keyword query reads the rows that may match instead of all titles.

Two Parquet folders: ``postings (gram, dedup_key)``, in ranges of gram and key with gram borders in every row group, so a frequent gram is spread
over files and a query reads only its own grams; and ``counts (gram, n)``. Titles and patterns are lower-cased by the
function that ``ilike`` uses, so whatever a pattern says literally stands in a matching title bigram by bigram.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.functions.text import let
from newsledger.session import materialize

MOST_GRAMS = 8


def bigrams(text: Column) -> Column:
    """The distinct pairs of neighbouring characters of ``text`` in lower case; none for null or shorter texts."""
    def paired(letters: Column) -> Column:
        first = F.slice(letters, 1, F.greatest(F.size(letters) - 1, F.lit(0)))
        return F.transform(first, lambda c, i: F.concat(c, F.get(letters, i + 1)))

    pairs = let(F.split(F.lower(text), ""), paired)  # split once, not once per character
    return F.coalesce(F.array_distinct(pairs), F.array().cast("array<string>"))


def literal_pieces(pattern: str) -> list[str]:
    """What a LIKE pattern says literally between its wildcards; a backslash takes the next character literally."""
    pieces = [""]
    for token in re.findall(r"(?s)\\.|.", pattern):
        if token in ("%", "_"):
            pieces.append("")
        else:
            pieces[-1] += token[-1]
    return [p for p in pieces if p]


class TitleIndex:
    """Indexes items by title below ``path``.

    ``add`` may be called for any increment, also again for changed titles or after a failure: old or repeated postings only make candidates, which the
    query checks against the titles. Null titles have no postings. Null keys are keys like any other.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, items: DataFrame) -> None:
        postings = items.select("dedup_key", F.explode(bigrams(F.col("title"))).alias("gram"))
        postings = materialize(postings.select("gram", "dedup_key"))
        ranged = postings.repartitionByRange("gram", "dedup_key").sortWithinPartitions("gram", "dedup_key")
        ranged.write.mode("append").parquet(f"{self.path}/postings")
        postings.groupBy("gram").agg(F.count("*").alias("n")).write.mode("append").parquet(f"{self.path}/counts")

    def grams(self, pattern: str) -> list[str]:
        """The bigrams that a title matching the LIKE ``pattern`` must have."""
        low = self.spark.range(1).select(F.lower(F.lit(pattern))).first()[0]
        return sorted({p[i:i + 2] for p in literal_pieces(low) for i in range(len(p) - 1)})

    def candidates(self, pattern: str) -> DataFrame | None:
        """The keys of titles that hold the pattern's rarest bigrams (up to ``MOST_GRAMS``); None if it has no bigrams."""
        grams = self.grams(pattern)
        if not grams:
            return None
        counts = self.spark.read.parquet(f"{self.path}/counts").filter(F.col("gram").isin(grams))
        known = dict(counts.groupBy("gram").agg(F.sum("n")).collect())
        wanted = sorted(grams, key=lambda g: (known.get(g, 0), g))[:MOST_GRAMS]
        postings = self.spark.read.parquet(f"{self.path}/postings")
        if wanted[0] not in known:
            return postings.select("dedup_key").limit(0)
        found = postings.filter(F.col("gram").isin(wanted)).groupBy("dedup_key")
        flags = [F.bool_or(F.col("gram") == g).alias(f"g{i}") for i, g in enumerate(wanted)]
        every = F.forall(F.array(*[F.col(f"g{i}") for i in range(len(wanted))]), lambda x: x)
        return found.agg(*flags).filter(every).select("dedup_key")

    def narrow(self, items: DataFrame, pattern: str) -> DataFrame:
        """The rows of ``items`` whose title may match the pattern; all where the pattern has no bigram."""
        keys = self.candidates(pattern)
        if keys is None:
            return items
        keys = keys.withColumnRenamed("dedup_key", "__key")
        return items.join(keys, F.col("dedup_key").eqNullSafe(F.col("__key")), "left_semi")

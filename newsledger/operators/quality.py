"""The contract towards consumers of the item table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.functions.pii import PiiScanner
from newsledger.functions.vectors import is_usable

MIN_CHARS = 300


def contract_rules(scanner: PiiScanner | None = None, dim: int = S.EMBEDDING_DIM) -> dict[str, Column]:
    """One boolean per rule which a row fulfils by itself."""
    scanner = scanner or PiiScanner()

    def long_enough(name: str) -> Column:
        return F.coalesce(F.length(name) >= MIN_CHARS, F.lit(False))

    return {
        "body_long": long_enough("body"),
        "summary_long": long_enough("summary"),
        "vector_usable": is_usable(F.col("embedding"), dim),
        "pii_free": scanner.is_safe(F.col("body")) & scanner.is_safe(F.col("summary")),
    }


def with_flags(rows: DataFrame, *names: str, **options) -> DataFrame:
    """Adds the named rules as boolean columns, for ``contract_check`` to find.

    Texts and vectors that lie in different tables are flagged there, so only flags and keys meet in the join.
    """
    rules = contract_rules(**options)
    return rows.withColumns({n: rules[n] for n in names})


def contract_check(items: DataFrame, key: str = "dedup_key", **options) -> DataFrame:
    """``(rule, n_rows, n_failed)`` over the table, ``key_unique`` counting the rows whose key occurs
    more than once.

    One aggregation per key with map-side counting, so a key with most of the rows is a single row
    after the shuffle; the totals follow from the per-key counts.
    """
    rules = {n: F.col(n) if n in items.columns else c for n, c in contract_rules(**options).items()}
    flagged = items.select(F.col(key).alias("key"), *[c.alias(n) for n, c in rules.items()])
    per_key = flagged.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(~F.col(n)).alias(n) for n in rules]
    )
    unique = F.sum(F.when((F.col("n") > 1) | F.col("key").isNull(), F.col("n")).otherwise(0))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        unique.alias("key_unique"),
        *[F.sum(n).alias(n) for n in rules],
    )
    return _per_rule(totals, rules)


def _per_rule(totals: DataFrame, rules) -> DataFrame:
    names = ["key_unique", *rules]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(n), F.lit(0)).alias("n_failed")) for n in names]
    )
    return totals.select("n_rows", F.inline(pairs)).select("rule", "n_rows", "n_failed")


class ContractCounts:
    """Counts ``contract_check`` while rows are written, so that nothing is read again.

    ``watch`` marks the rows of one write; ``rows`` gives the totals of all writes once they are done. Put right above the
    write, after its shuffle, the counts are those of result tasks: a task that runs again counts once. The writer stores one row per key, so
    ``key_unique`` counts null keys alone. Rows that an update rewrites are counted with the rest.
    """

    def __init__(self, key: str = "dedup_key", **options):
        self.key, self.options, self.observations = key, options, []

    def watch(self, rows: DataFrame) -> DataFrame:
        seen = Observation()
        self.observations.append(seen)
        failed = {"key_unique": F.col(self.key).isNull()} | {n: ~c for n, c in contract_rules(**self.options).items()}
        return rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(n) for n, c in failed.items()])

    def rows(self, spark: SparkSession) -> DataFrame:
        """``(rule, n_rows, n_failed)``; waits for the writes."""
        rules = list(contract_rules(**self.options))
        names = ["n_rows", "key_unique", *rules]
        seen = [[o.get[n] for n in names] for o in self.observations] or [[0] * len(names)]
        totals = spark.createDataFrame([[sum(column) for column in zip(*seen)]], ", ".join(f"{n} long" for n in names))
        return _per_rule(totals, rules)

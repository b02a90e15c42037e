"""Reports on personal data and keeping sensitive rows apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.functions.pii import PiiScanner
from newsledger.functions.vectors import constant_vector


def pii_rules(spark: SparkSession, scanner: PiiScanner | None = None) -> DataFrame:
    """The active rules ``(priority, kind, pattern, placeholder)`` in priority order."""
    rules = (scanner or PiiScanner()).rules
    rows = [(i + 1, r.kind, r.pattern, r.placeholder) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "priority int, kind string, pattern string, placeholder string")


def pii_scan(df: DataFrame, keys: list[str], text: str = "text", scanner: PiiScanner | None = None) -> DataFrame:
    """One row ``(keys, pos, kind, value)`` per hit, ``pos`` counting from 0 within a text."""
    hits = (scanner or PiiScanner()).hits(F.col(text))
    return df.select(*keys, F.posexplode(hits).alias("pos", "hit")).select(
        *keys, "pos", "hit.kind", "hit.value"
    )


def pii_report(df: DataFrame, by: list[str], text: str = "text", scanner: PiiScanner | None = None) -> DataFrame:
    """Hits per kind and ``by`` columns, kinds without a hit left out.

    Counted map-side first, so a group with most of the rows costs the shuffle a handful of rows.
    """
    kinds = (scanner or PiiScanner()).hit_kinds(F.col(text))
    return (
        df.select(*by, F.explode(kinds).alias("kind"))
        .groupBy(*by, "kind")
        .agg(F.count(F.lit(1)).alias("n_hits"))
    )


def rule_usage(df: DataFrame, text: str = "text", scanner: PiiScanner | None = None) -> DataFrame:
    """Every active rule with the number of its hits in ``df``, zero included."""
    scanner = scanner or PiiScanner()
    usage = pii_report(df, [], text, scanner)
    return (
        pii_rules(df.sparkSession, scanner)
        .join(usage, "kind", "left")
        .select("priority", "kind", "placeholder", F.coalesce("n_hits", F.lit(0)).alias("n_hits"))
    )


def is_cloud_safe(columns: tuple[str, ...] = ("body",), scanner: PiiScanner | None = None):
    """True iff none of the columns holds personal data."""
    scanner = scanner or PiiScanner()
    safe = F.lit(True)
    for name in columns:
        safe = safe & scanner.is_safe(F.col(name))
    return safe


def quarantine(
    items: DataFrame, columns: tuple[str, ...] = ("body",), scanner: PiiScanner | None = None,
    dim: int = S.EMBEDDING_DIM,
) -> DataFrame:
    """Sensitive items get the fixed notice, top importance and the constant vector, keep their raw body
    and stay unanalysed; the others pass unchanged. ``is_quarantined`` tells them apart.

    One projection instead of a split and a union: the texts are read once.
    """
    flagged = items.withColumn("is_quarantined", ~is_cloud_safe(columns, scanner))
    hit = F.col("is_quarantined")
    old_vector = F.col("embedding") if "embedding" in items.columns else F.lit(None)
    return flagged.withColumns(
        {
            "summary": F.when(hit, F.lit(S.QUARANTINE_SUMMARY)).otherwise(F.col("summary")),
            "importance": F.when(hit, F.lit(S.QUARANTINE_IMPORTANCE))
            .otherwise(F.col("importance"))
            .cast("short"),
            "embedding": F.when(hit, constant_vector(dim)).otherwise(old_vector),
        }
    )

from pyspark.sql import functions as F

from catalog import register, sql_pii
from catalog.tables import ITEMS_SQL, documents_as_items, read
from newsledger import schema as S
from newsledger.functions.pii import CUSTOM_KIND, CUSTOM_PLACEHOLDER, RULES, PiiScanner
from newsledger.operators import pii

_KINDS = sql_pii.kinds_and_placeholders()
_HITS = f"""
lists AS (
  SELECT doc_id, source, {sql_pii.hit_lists("text", sql_pii.combined(), len(_KINDS))} AS found
  FROM documents WHERE regexp_matches(text, {sql_pii.combined()})),
hits AS (
  SELECT doc_id, source, p - 1 AS pos, k, found[k][p] AS value
  FROM lists, range(1, {len(_KINDS) + 1}) AS kinds(k), unnest(range(1, len(found[1]) + 1)) AS positions(p)
  WHERE coalesce(found[k][p], '') <> ''),
rules AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, '{k}', '{p}')" for i, (k, p) in enumerate(_KINDS))})
          AS t(k, kind, placeholder))
"""


@register(
    "pii_report",
    f"WITH {_HITS} SELECT source, kind, count(*) AS n_hits FROM hits JOIN rules USING (k) GROUP BY ALL",
)
def pii_report(spark, sf):
    return pii.pii_report(read(spark, sf, "documents"), ["source"])


@register(
    "pii_scan",
    f"WITH {_HITS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, kind, value FROM hits JOIN rules USING (k)",
)
def pii_scan(spark, sf):
    return pii.pii_scan(read(spark, sf, "documents"), ["doc_id"])


@register("pii_mask", f"SELECT doc_id, {sql_pii.mask('text')} AS masked FROM documents")
def pii_mask(spark, sf):
    return read(spark, sf, "documents").select("doc_id", PiiScanner().mask(F.col("text")).alias("masked"))


@register("pii_safe", f"SELECT doc_id, {sql_pii.is_safe('text')} AS is_safe FROM documents")
def pii_safe(spark, sf):
    return read(spark, sf, "documents").select("doc_id", PiiScanner().is_safe(F.col("text")).alias("is_safe"))


@register(
    "pii_counts",
    f"""WITH {_HITS}, n AS (SELECT doc_id, kind, count(*) AS c FROM hits JOIN rules USING (k) GROUP BY ALL),
    t AS (SELECT doc_id, string_agg(kind || '=' || c, ',' ORDER BY kind) AS counts FROM n GROUP BY doc_id)
    SELECT doc_id, coalesce(counts, '') AS counts FROM documents LEFT JOIN t USING (doc_id)""",
)
def pii_counts(spark, sf):
    counts = F.array_sort(F.map_entries(PiiScanner().counts(F.col("text"))))
    text = F.transform(counts, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return read(spark, sf, "documents").select("doc_id", F.array_join(text, ",").alias("counts"))


@register(
    "pii_rules",
    f"""WITH {_HITS}, n AS (SELECT k, count(*) AS n_hits FROM hits GROUP BY k),
    every AS (SELECT * FROM rules UNION ALL SELECT {len(RULES)}, 'CHINESE_NAME', '[CHINESE_NAME]')
    SELECT CAST(k AS INTEGER) AS priority, kind, placeholder, coalesce(n_hits, 0) AS n_hits
    FROM every LEFT JOIN n USING (k)""",
)
def pii_rules(spark, sf):
    return pii.rule_usage(read(spark, sf, "documents"))


_WORDS = ["token =", "(555)", "the "]
_WORDS_SQL = r"token =|\(555\)|the "


@register(
    "pii_custom",
    "SELECT doc_id, "
    + sql_pii.mask("text", _WORDS_SQL, (CUSTOM_KIND, CUSTOM_PLACEHOLDER))
    + " AS masked FROM documents",
)
def pii_custom(spark, sf):
    scanner = PiiScanner(_WORDS)
    return read(spark, sf, "documents").select("doc_id", scanner.mask(F.col("text")).alias("masked"))


KEYWORDS = 5_000


@register(
    "pii_custom_many",
    f"""WITH hit AS (SELECT k.p_partkey, min(j.p_partkey) AS word FROM part k JOIN part j ON j.p_name = k.p_name
      AND starts_with(k.p_partkey::VARCHAR, j.p_partkey::VARCHAR) AND j.p_partkey < {KEYWORDS} GROUP BY k.p_partkey)
    SELECT p_partkey, CASE WHEN word IS NULL THEN 'Order of ' || p_name || ' ' || p_partkey
      ELSE 'Order of {CUSTOM_PLACEHOLDER}' || substr(p_partkey::VARCHAR, length(word::VARCHAR) + 1) END || ' from ' || p_brand AS masked
    FROM part LEFT JOIN hit USING (p_partkey)""",
)
def pii_custom_many(spark, sf):
    """Article names and numbers as the caller's keywords, in the order of their numbers: the first that matches wins, not the longest."""
    part = read(spark, sf, "part")
    article = F.concat_ws(" ", "p_name", "p_partkey")
    words = [r[0] for r in part.filter(F.col("p_partkey") < KEYWORDS).orderBy("p_partkey").select(article).collect()]
    text = F.concat(F.lit("Order of "), article, F.lit(" from "), "p_brand")
    return part.select("p_partkey", PiiScanner(words).mask(text).alias("masked"))


@register(
    "quarantine",
    f"""WITH {ITEMS_SQL}, f AS (SELECT *, NOT ({sql_pii.is_safe('body')}) AS hit FROM items)
    SELECT dedup_key, hit AS is_quarantined,
           CASE WHEN hit THEN '{S.QUARANTINE_SUMMARY}' ELSE summary END AS summary,
           CAST(CASE WHEN hit THEN {S.QUARANTINE_IMPORTANCE} ELSE importance END AS INTEGER) AS importance,
           CASE WHEN hit THEN {S.EMBEDDING_DIM} ELSE 0 END AS n_vector, md5(body) AS body_md5
    FROM f""",
)
def quarantine(spark, sf):
    done = pii.quarantine(documents_as_items(spark, sf))
    return done.select(
        "dedup_key",
        "is_quarantined",
        "summary",
        F.col("importance").cast("int").alias("importance"),
        F.coalesce(F.size("embedding"), F.lit(0)).alias("n_vector"),
        F.md5("body").alias("body_md5"),
    )

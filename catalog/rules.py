"""Every detection rule on texts made from order keys, with the hits computed from the keys alone."""

from pyspark.sql import functions as F

from catalog import register
from catalog.tables import read
from newsledger.functions.pii import PiiScanner
from newsledger.operators import pii

# kind, placeholder, and the value for the key k in SQL that both engines read alike; what follows the value in the text.
CASES = (
    ("TAIWAN_ID", "[TAIWAN_ID]", "concat('A1', lpad(cast(k AS STRING), 8, '0'))", ""),
    ("CREDIT_CARD", "[CREDIT_CARD]", "concat('4000-1234-', lpad(cast(k % 10000 AS STRING), 4, '0'), '-9876')", ""),
    ("PHONE_MOBILE", "[PHONE_MOBILE]", "concat('0912-345-', lpad(cast(k % 1000 AS STRING), 3, '0'))", ""),
    ("PHONE_LANDLINE", "[LANDLINE]", "concat('02-2345-', lpad(cast(k % 10000 AS STRING), 4, '0'), ' #12')", ""),
    ("EMAIL", "[EMAIL]", "concat('user.', cast(k AS STRING), '@mail.example.com')", ""),
    ("BANK_ACCOUNT", "[BANK_ACCOUNT]", "concat('9', lpad(cast(k AS STRING), 11, '0'))", ""),
    ("RESIDENT_CERT", "[RESIDENT_CERT]", "concat('AB', lpad(cast(k AS STRING), 8, '0'))", ""),
    ("TXN_ID", "[TXN_ID]", "concat('TXN', lpad(cast(k AS STRING), 9, '0'))", ""),
    ("EMP_ID", "[EMP_ID]", "concat('E', lpad(cast(k % 100000 AS STRING), 5, '0'))", ""),
    ("IP_ADDR_V4", "[IP_ADDR]", "concat('10.1.', cast(k % 256 AS STRING), '.7')", ""),
    ("IP_ADDR_V6", "[IP_ADDR]", "concat('2001:db8:', lower(hex(k % 65536)), ':beef')", ""),
    ("CHINESE_NAME", "[CHINESE_NAME]", "concat('王小', substr('明華美強', cast(k % 4 + 1 AS INT), 1))", "先生"),
)


def _case(of) -> str:
    return "CASE " + " ".join(f"WHEN k % {len(CASES)} = {i} THEN {of(case)}" for i, case in enumerate(CASES)) + " END"


KIND, PLACEHOLDER, VALUE, AFTER = (_case(of) for of in (lambda c: f"'{c[0]}'", lambda c: f"'{c[1]}'", lambda c: c[2], lambda c: f"'{c[3]}'"))
NOTES_SQL = f"""notes AS (SELECT o_orderkey AS k, {KIND.replace("k %", "o_orderkey %")} AS kind,
    {PLACEHOLDER.replace("k %", "o_orderkey %")} AS placeholder, v AS value, a AS after
    FROM (SELECT o_orderkey, o_orderkey AS k, {VALUE} AS v, {AFTER} AS a FROM orders))"""


def _notes(spark, sf):
    keys = read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return keys.select("k", F.expr(f"concat('note ', {VALUE}, {AFTER}, ' end')").alias("text"))


@register("pii_all_scan", f"WITH {NOTES_SQL} SELECT k, 0 AS pos, kind, value FROM notes")
def pii_all_scan(spark, sf):
    return pii.pii_scan(_notes(spark, sf), ["k"])


@register("pii_all_mask", f"WITH {NOTES_SQL} SELECT k, 'note ' || placeholder || after || ' end' AS masked FROM notes")
def pii_all_mask(spark, sf):
    return _notes(spark, sf).select("k", PiiScanner().mask(F.col("text")).alias("masked"))


@register("pii_all_safe", f"WITH {NOTES_SQL} SELECT k, false AS is_safe FROM notes")
def pii_all_safe(spark, sf):
    return _notes(spark, sf).select("k", PiiScanner().is_safe(F.col("text")).alias("is_safe"))


@register("pii_all_rules", f"WITH {NOTES_SQL} SELECT kind, count(*) AS n_hits FROM notes GROUP BY kind")
def pii_all_rules(spark, sf):
    return pii.rule_usage(_notes(spark, sf)).groupBy("kind").agg(F.sum("n_hits").alias("n_hits"))

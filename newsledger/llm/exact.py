"""Exact deduplication by deterministic block naming, in DataFrame operations alone.

A text's bytes are cut into blocks of a fixed size. Distinct blocks are sorted and numbered; a text becomes a row of
integers. Then distinct pairs of neighbouring names are sorted and numbered in turn, which halves the rows, until one name is left
per text: equal names at the same level mean equal texts. Blocks meet their names through a 128-bit key of the block; that no two different
blocks share a key is checked over the distinct blocks themselves, and other keys are taken if two do, so names are
free of collisions. Block texts are shuffled once, copies are combined before that; the rest moves integers. Frequent blocks only
occur in aggregates with map-side combining and in joins that adaptive execution may split.

Cases: null text counts as empty; the empty text is one block; of rows with the largest id one stays, also when ids repeat or
are null (null ids come last); an empty table gives no rows; further columns are ignored by ``find`` and kept by ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.shared import documents, stored, texts_of

BLOCK_BYTES = 8192


def _blocks(text, size: int):
    raw = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(raw) / size).cast("int"), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * size + 1, F.lit(size)))


def _key(block, seed: int):
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("h1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("h2"))


def row_key(doc_id, text_sha256):
    """What identifies a row up to exact repetition: its id and its text."""
    return F.sha2(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text_sha256), 256)


def block_names(docs: DataFrame, size: int, seed: int = 0) -> tuple[DataFrame, int]:
    """Distinct blocks by their keys, numbered in order, and the seed whose keys tell all of them apart."""
    blocks = texts_of(docs).select(F.explode(_blocks(F.col("text"), size)).alias("block"))
    distinct = blocks.select(_key(F.col("block"), seed)["h1"].alias("h1"), _key(F.col("block"), seed)["h2"].alias("h2"), "block").groupBy("h1", "h2", "block").agg(F.lit(1).alias("one"))
    keys = stored(distinct.groupBy("h1", "h2").agg(F.count("*").alias("blocks")), "block-keys")
    if not keys.filter("blocks > 1").isEmpty():
        return block_names(docs, size, seed + 1)
    return numbered(keys.select("h1", "h2")), seed


def numbered(keys: DataFrame) -> DataFrame:
    """Distinct keys in sorted order with an integer each, stored."""
    return stored(keys.orderBy(*keys.columns).withColumn("name", F.monotonically_increasing_id()), "names")


def find(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id``, ``row_key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    names, seed = block_names(docs, size)
    rows = stored(
        texts_of(docs).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("text"), size), lambda b: _key(b, seed)).alias("keys"),
        ),
        "block-rows",
    )
    level, longest = 0, rows.agg(F.max(F.size("keys"))).first()[0] or 0
    parts = rows.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key")).select("row", "n", "pos", "key.h1", "key.h2")
    named = parts.join(names, ["h1", "h2"]).select("row", "n", "pos", "name")
    done = named.filter("n = 1").select("row", F.lit(0).alias("level"), "name")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        pairs = stored(
            named.filter("n > 1").groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
                F.ceil(F.first("n") / 2).cast("int").alias("n"),
            ),
            "block-pairs",
        )
        named = pairs.join(numbered(pairs.select("a", "b").distinct()), ["a", "b"]).select("row", "n", "pos", "name")
        done = done.unionByName(named.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
    identified = stored(rows.select("row", "doc_id", "text_sha256").join(done, "row"), "identities")
    # A table of its own: the join may then split the rows of a text with many copies.
    groups = stored(identified.groupBy("level", "name").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")), "copy-groups")
    return identified.join(groups, ["level", "name"]).select(
        "doc_id", row_key(F.col("doc_id"), F.col("text_sha256")).alias("row_key"), F.col("keep.doc_id").alias("keep_id"),
        "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256",
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all columns of ``docs``."""
    kept = find(docs).filter("kept").select(F.col("row_key").alias("_newsledger_row"))
    key = row_key(F.col("doc_id").cast("long"), F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.withColumn("_newsledger_row", key).join(kept, "_newsledger_row", "left_semi").dropDuplicates(["_newsledger_row"]).drop("_newsledger_row")


@query("op4_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir)).drop("row_key")

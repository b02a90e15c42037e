"""Token ids as Parquet files in document order, read back selectively.

A file set holds one row per document: ``doc_id``, ``n_tokens``, ``shard``, ``shard_start`` (ids of the shard
before the document) and ``token_ids`` (list of int). Ids are dictionary-encoded (one dictionary page per row group,
16 bits an id), the other integers delta-encoded; rows are sorted by ``doc_id``, row groups are small and have column and
page indexes, so reading some documents, or counts without ids, touches few pages. Spark's committer writes the files.

Cases: null text is empty (the end id alone); null ids come first; repeated ids keep all their rows, ordered by text; an empty
table gives no rows; further columns are ignored. A text's ids lie in one row: its length is bounded by one row's memory.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.chunks import BYTE_BPE, encoder, vocabulary, with_end
from newsledger.llm.shared import documents, shared_path, texts_of

SCHEMA = "doc_id long, n_tokens long, shard int, shard_start long, token_ids array<int>"
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#token_ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "compression": "zstd",
}
BATCH_CHARS = 1_500_000


def slices(batches, column: str = "text", chars: int = BATCH_CHARS):
    """Arrow batches cut to a bounded number of characters, with the texts as strings; only a cut's texts are strings at a time."""
    for batch in batches:
        start = size = 0
        for i, length in enumerate(pc.utf8_length(batch.column(column)).to_numpy().tolist()):
            size += length
            if size > chars:
                part = batch.slice(start, i + 1 - start)
                yield part, part.column(column).to_pylist()
                start, size = i + 1, 0
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, part.column(column).to_pylist()


def encode_rows(path: str, end_id: int):
    """Arrow batches of sorted documents to rows of the file format."""

    def run(batches):
        shard, start = TaskContext.get().partitionId(), 0
        for batch, texts in slices(batches):
            ids, offsets = with_end(*encoder(path).encode(texts), end_id)
            counts = np.diff(offsets)
            begins = start + offsets[:-1]
            start += int(offsets[-1])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(np.full(len(texts), shard, np.int32)), pa.array(begins), lists],
                ["doc_id", "n_tokens", "shard", "shard_start", "token_ids"],
            )

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, **layout: str) -> None:
    """Writes the whole texts of ``docs`` as token ids under ``path``; ``layout`` overrides Parquet settings."""
    ordered = texts_of(docs).withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    rows = ordered.select("doc_id", "text").mapInArrow(encode_rows(tokenizer, end_id), SCHEMA)
    writer = rows.write
    for key, value in {**LAYOUT, **layout}.items():
        writer = writer.option(key, value)
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as a table; filters on ``doc_id`` and column choices reach the pages."""
    return spark.read.schema(SCHEMA).parquet(path)


def crc32_of_ids():
    """A column function: the unsigned crc32 of a list of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(lists: pa.Array) -> pa.Array:
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = lists.offsets.to_numpy()
        return pa.array([zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.int64())

    return crc


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: where its ids start in the whole, their number and checksum.

    The totals before each shard come from the small columns alone, one row per shard.
    """
    table = read_tokens(spark, path)
    totals = table.groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    rows = table.select("doc_id", "n_tokens", "shard", "shard_start", crc32_of_ids()("token_ids").alias("ids_crc32"))
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, vocabulary(BYTE_BPE), end_id=2)
    return digest(spark, path)

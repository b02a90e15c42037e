"""Packing documents into sequences of a fixed number of tokens: shortest pack first over the histogram of lengths.

Documents longer than a sequence are cut into full sequences and a rest. The histogram of piece lengths (at most ``size``
entries, whatever the corpus) goes to the driver, where lengths are placed longest first, each into the packs with the
most room, as runs of sequences that are filled alike. No more packs are opened than the tokens need: from then on a piece that
fits nowhere is cut to fill the largest gaps, so that at most one sequence's worth is padded in all. The runs go back to
the pieces by their rank among pieces of the same length; no sequence is ever assembled on the driver.

Cases: null text is empty (the end id alone); null and repeated ids keep all their rows; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.chunks import WORD_BPE, encoder, vocabulary, with_end
from newsledger.llm.shared import documents, stored, texts_of
from newsledger.llm.token_files import slices

ENCODED = (
    "doc_id long, shard int, row long, n_tokens long, crcs array<long>, full_rank long, rest int, rest_rank long, rest_ids binary"
)
PLACED = "doc_id long, shard int, row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SHARDS_A_TASK = 16
# length, ranks from and to, part of the piece, first sequence, place in it
Run = tuple[int, int, int, int, int, int, int]


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Run]:
    """Where the pieces of each length go: rank ``from + i`` puts its tokens ``cut .. cut + n`` into sequence ``first + i``.

    Each run is ``(length, from, to, cut, n, first, offset)``; a piece that is not cut lies in one run with ``n = length``.
    """
    limit = -(-sum(length * count for length, count in histogram.items()) // size)
    rooms: dict[int, list[tuple[int, int]]] = {}
    opened, runs = 0, []
    for length in sorted(histogram, reverse=True):
        todo = [(0, histogram[length], 0)]
        while todo:
            rank, left, cut = todo.pop()
            need = length - cut
            gap = max(rooms, default=0)
            if gap < need and opened < limit and not cut:
                used, gap, first = min(left, limit - opened), size, opened
                opened += used
            else:
                first, packs = rooms[gap].pop()
                if not rooms[gap]:
                    del rooms[gap]
                used = min(left, packs)
                if packs > used:
                    rooms.setdefault(gap, []).append((first + used, packs - used))
            put = min(need, gap)
            runs.append((length, rank, rank + used, cut, put, first, size - gap))
            if gap > put:
                rooms.setdefault(gap - put, []).append((first, used))
            if left > used:
                todo.append((rank + used, left - used, cut))
            if need > put:
                todo.append((rank, used, cut + put))
    return runs


class Placement:
    """Looks up runs by length and rank: intervals of ranks of one length, each with the runs that hold there."""

    def __init__(self, runs: list[Run]):
        by_length: dict[int, list[Run]] = {}
        for run in runs:
            by_length.setdefault(run[0], []).append(run)
        keys, counts, rows = [], [], []
        for length in sorted(by_length):
            own = sorted(by_length[length], key=lambda r: r[3])
            for begin in sorted({r[1] for r in own}):
                here = [(r[3], r[4], r[5] - r[1], r[6]) for r in own if r[1] <= begin < r[2]]
                keys.append((length << 44) + begin)
                counts.append(len(here))
                rows += here
        self.keys = np.array(keys, np.int64)
        self.borders = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.rows = np.array(rows, np.int64).reshape(-1, 4)
        self.cut_lengths = sorted({r[0] for r in runs if r[4] < r[0]})

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece, once per part of it: the piece's index and (cut, n, sequence, offset)."""
        at = np.searchsorted(self.keys, (lengths.astype(np.int64) << 44) + ranks, side="right") - 1
        counts = self.borders[at + 1] - self.borders[at]
        piece = np.repeat(np.arange(len(at)), counts)
        ends = np.cumsum(counts)
        found = self.rows[np.repeat(self.borders[at] - (ends - counts), counts) + np.arange(len(piece))].copy()
        found[:, 2] += ranks[piece]
        return piece, found


def _encode(path: str, end_id: int, size: int):
    def run(batches):
        shard, row, seen = TaskContext.get().partitionId(), 0, Counter()
        for batch, texts in slices(batches):
            ids, offsets = with_end(*encoder(path).encode(texts), end_id)
            ids = ids.astype("<u4")
            crcs, full, rest_rank, rests = [], [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                whole, rest = divmod(b - a, size)
                crcs.append([zlib.crc32(ids[k:min(k + size, b)]) for k in range(a, b, size)])
                full.append(seen[size])
                seen[size] += whole
                rest_rank.append(seen[rest])
                seen[rest] += rest > 0
                rests.append(ids[b - rest:b].tobytes())
            counts = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(texts), shard, np.int32)), pa.array(np.arange(row, row + len(texts))),
                 pa.array(counts), pa.array(crcs, pa.list_(pa.int64())), pa.array(full, pa.int64()),
                 pa.array((counts % size).astype(np.int32)), pa.array(rest_rank, pa.int64()), pa.array(rests, pa.binary())],
                ["doc_id", "shard", "row", "n_tokens", "crcs", "full_rank", "rest", "rest_rank", "rest_ids"],
            )
            row += len(texts)

    return run


def encode(docs: DataFrame, tokenizer: str, size: int, end_id: int = 2) -> DataFrame:
    """Stored: one row per document with its length, checksums of its pieces, ranks within the task, and the ids of its rest."""
    return stored(texts_of(docs).mapInArrow(_encode(tokenizer, end_id, size), ENCODED), "packing")


def _place(placement: Placement):
    def run(batches):
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            piece, found = placement.find(lengths, ranks)
            rows, cut_ids = batch.drop_columns(["cut_ids"]).take(pa.array(piece)), batch.column("cut_ids")
            crc = rows.column("crc").to_numpy().copy()
            for k in np.flatnonzero(found[:, 1] != lengths[piece]).tolist():
                a, n = found[k, :2].tolist()
                crc[k] = zlib.crc32(cut_ids[int(piece[k])].as_buffer()[4 * a:4 * (a + n)])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("shard"), rows.column("row"), pa.array(rows.column("begin").to_numpy() + found[:, 0]),
                 pa.array(found[:, 1].copy()), pa.array(crc), rows.column("n_tokens"), pa.array(found[:, 2].copy()), pa.array(found[:, 3].copy())],
                ["doc_id", "shard", "row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def place(encoded: DataFrame, size: int) -> DataFrame:
    """The parts of all documents with their sequence and offset. Ids travel only with the pieces that are cut further."""
    rest = F.array(F.struct((F.col("n_tokens") - F.col("rest")).alias("begin"), F.col("rest").alias("length"), F.col("rest_rank").alias("local")))
    full = F.transform(
        F.when(F.col("n_tokens") >= size, F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_tokens") / size) - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda k: F.struct((k * size).alias("begin"), F.lit(size).alias("length"), (F.col("full_rank") + k).alias("local")),
    )
    exploded = encoded.select(
        "doc_id", "shard", "row", "n_tokens", "crcs", "rest_ids", F.explode(F.concat(full, F.when(F.col("rest") > 0, rest).otherwise(F.slice(rest, 1, 0)))).alias("p")
    )
    # A task counts the pieces of several shards, each of at most ``size`` lengths: the counts are few files whatever the shuffle partitions.
    last = encoded.agg(F.max("shard")).first()[0] or 0
    tasks = math.ceil((last + 1) / SHARDS_A_TASK)
    counts = stored(exploded.groupBy("shard", F.col("p.length").alias("length")).agg(F.count("*").alias("n")).coalesce(tasks), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placement = Placement(shortest_pack_first(histogram, size))
    pieces = exploded.select(
        "doc_id", "shard", "row", "n_tokens", "p.*", F.element_at("crcs", (F.col("p.begin") / size).cast("int") + 1).alias("crc"),
        F.when((F.col("p.length") < size) & F.col("p.length").isin(placement.cut_lengths), F.col("rest_ids")).alias("cut_ids"),
    )
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["shard", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    return ranked.mapInArrow(_place(placement), PLACED)


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per part of a document: its ids ``start .. start + length`` lie in ``sequence_id`` from ``offset`` on."""
    return place(encode(docs, tokenizer, size, end_id), size)


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), vocabulary(WORD_BPE)).drop("shard", "row")

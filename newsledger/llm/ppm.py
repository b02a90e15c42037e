"""Language-model scoring by prediction by partial matching over bytes, with a word-count baseline.

The byte n-grams of all training texts are counted in Spark; counts of shorter ones follow by summing. They form the contexts
up to ``order`` bytes. A byte is predicted in the longest known context; if it was not seen there, an escape leads to the next
shorter one, in which the symbols of the longer context are excluded. Escapes are estimated by the number of distinct symbols
(method C). Every symbol of a context also occurs in its shorter contexts, so what is excluded depends on the context alone. A text
ends with an end symbol (byte 255, which UTF-8 never has), so scores are log10 probabilities of whole texts.

A byte's probability depends on it and the ``order`` bytes before it alone, so each distinct gram of all texts gets its logarithm once, by
joins of gram tables in which no key has more than 256 partners. Texts add these up. The ``cached_grams`` most used grams are sent to
every task; any other gram meets its logarithm in a join, and so do words beyond the ``most_words`` most frequent in the baseline. Both
settings change costs only. ``most_grams`` makes a smaller model on request: n-grams beyond that many are unknown.

Cases: null text is empty and has the end token alone; null ids belong to the training part; repeated ids keep all their rows; without training texts
bytes are equally likely; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.shared import documents, fold, kept_by_worker, release_worker, stored, texts_of
from newsledger.llm.token_files import slices

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
END = 255
SYMBOLS = 256
FLUSH = 600_000
GRAM_ROWS = 200_000
PART_CHARS = 400_000


def normal(text: str) -> bytes:
    return text.encode().translate(LOWER)


def contexts(raws: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each coded byte (the texts' and an end each) the ``order`` bytes before it and itself as one integer; and the texts' lengths."""
    pad = bytes([END]) * order
    raw = np.frombuffer(pad + b"".join(r + pad for r in raws), np.uint8)
    sizes = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    keys = np.zeros(len(raw) - order, np.uint64)
    for k in range(order + 1):
        keys = keys << np.uint64(8) | raw[k:len(raw) - order + k]
    begins = np.cumsum(sizes + order - 1) - (sizes + order - 1)
    ends = np.cumsum(sizes)
    return keys[np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their counts added up. Empties both lists: the parts are not kept beside the whole."""
    values, n = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(values)
    values, n = values[order], n[order]
    del order
    heads = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[heads], np.add.reduceat(n, heads)


def _count_grams(order: int):
    def rows(values, n):
        for k in range(0, len(values), GRAM_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(values[k:k + GRAM_ROWS].astype(np.int64)), pa.array(n[k:k + GRAM_ROWS])], ["gram", "n"])

    def run(batches):
        release_worker()
        keys, counts, fresh = [], [], 0
        for _, texts in slices(batches, chars=PART_CHARS):
            values, n = np.unique(contexts([normal(t) for t in texts], order)[0], return_counts=True)
            keys.append(values)
            counts.append(n)
            fresh += len(values)
            if fresh > 2 * FLUSH:
                values, n = _merged(keys, counts)
                keys, counts, fresh = [values], [n], 0
                if len(values) > 3 * FLUSH:
                    yield from rows(values, n)
                    keys, counts = [], []
        if keys:
            yield from rows(*_merged(keys, counts))

    return run


def _count_words(batches):
    def rows(counter):
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counter], pa.string()), pa.array(list(counter.values()), pa.int64())], ["word", "n"])

    release_worker()
    counter: Counter[bytes] = Counter()
    for _, texts in slices(batches, chars=PART_CHARS):
        for text in texts:
            counter.update(normal(text).split())
        if len(counter) > FLUSH:
            yield rows(counter)
            counter = Counter()
    if counter:
        yield rows(counter)


def least_count(counts: DataFrame, most: int) -> float:
    """The least count such that at most ``most`` rows of ``counts`` have it, from a histogram of at most 300 bins."""
    bins = counts.groupBy(F.floor(F.log(F.col("n").cast("double")) * 4).cast("int").alias("bin")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    total, least = 0, float("inf")
    for row in sorted(bins, key=lambda r: -r.bin):
        total += row["rows"]
        if total > most:
            break
        least = row.least
    return least


class Table:
    """Integer keys with values, found by hashing: open addresses in arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = np.uint64(max(4, int(2 * len(keys)).bit_length()))
        self.slots = np.zeros(1 << int(self.bits), np.uint64)
        self.rows = np.full(1 << int(self.bits), -1, np.int32)
        todo, at = np.arange(len(keys)), self._home(keys)
        while len(todo):
            free = self.rows[at] < 0
            self.rows[at[free]] = todo[free]
            placed = self.rows[at] == todo
            self.slots[at[placed]] = keys[todo[placed]]
            todo, at = todo[~placed], (at[~placed] + 1) & (len(self.rows) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> (np.uint64(64) - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        rows = self.rows[at]
        open_ = np.flatnonzero((rows >= 0) & (self.slots[at] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.rows) - 1)
            rows[open_] = self.rows[at[open_]]
            open_ = open_[(rows[open_] >= 0) & (self.slots[at[open_]] != keys[open_])]
        return rows


def _suffix(shorter: int) -> Column:
    """A gram or context of ``length`` in bytes without its first ones: ``length - shorter`` bytes are left."""
    return F.expr(f"gram & (shiftleft(1L, 8 * (length - {shorter})) - 1)")


def log_probabilities(longest: DataFrame, grams: DataFrame, order: int, least: float) -> DataFrame:
    """``gram``, ``uses`` and ``value``: log10 of the probability of the last byte of each gram of ``longest(gram, n, uses)``.

    ``grams(length, gram, n)`` has the training counts, ``least`` or more, of all lengths up to ``order + 1``.
    """
    context = F.shiftright("gram", 8).alias("context")
    contexts = stored(grams.groupBy("length", context).agg(F.sum("n").alias("total"), F.count("*").alias("distinct")), "contexts")
    known, all_ = F.col("n") >= least, F.col("total") + F.col("distinct")
    here = contexts.filter(F.col("length") == order + 1).drop("length")
    seen = longest.filter(known).select("gram", "uses", "n", context).join(here, "context").select("gram", "uses", (F.log10("n") - F.log10(all_)).alias("value"))

    # What was not seen, and its suffixes, with what is known of them.
    ends = F.array(*(F.struct(F.lit(k).alias("length"), F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")) for k in range(1, order + 2)))
    asked = longest.filter(~known).select(F.explode(ends).alias("end")).select("end.length", "end.gram").distinct()
    facts = asked.join(grams, ["length", "gram"], "left").select("length", "gram", "n", context).join(contexts, ["length", "context"], "left")
    facts = stored(facts, "asked-grams")
    # The counts and number of symbols that a shorter context has besides those of the longer one.
    escaped = facts.filter("n IS NULL AND total IS NOT NULL AND length > 1").select("length", "context").distinct()
    shorter = grams.select((F.col("length") + 1).alias("length"), F.col("gram").alias("suffix"), F.col("n").alias("own"))
    excluded = grams.select("length", context, _suffix(1).alias("suffix")).join(escaped, ["length", "context"]).join(shorter, ["length", "suffix"])
    excluded = excluded.groupBy("length", "context").agg(F.sum("own").alias("own"), F.count("*").alias("symbols"))
    excluded = excluded.withColumn("parent", F.expr("context & (shiftleft(1L, 8 * (length - 2)) - 1)"))
    parents = contexts.select((F.col("length") + 1).alias("length"), F.col("context").alias("parent"), F.col("total").alias("whole"), F.col("distinct").alias("kinds"))
    rests = excluded.join(parents, ["length", "parent"]).select("length", "context", (F.col("whole") - F.col("own")).alias("rest"), (F.col("kinds") - F.col("symbols")).alias("others"))
    facts = stored(facts.join(rests, ["length", "context"], "left"), "asked-contexts")

    # From short to long: ``fresh`` in no longer context, ``below`` where the own context is known and lacks the byte.
    first = contexts.filter("length = 1").first()
    below = F.lit(-math.log10(max(SYMBOLS - (first.distinct if first else 0), 1)))
    found, rest = None, F.col("rest") + F.col("others")
    for length in range(1, order + 2):
        own, fresh = facts.filter(F.col("length") == length), below
        if found is not None:
            own = own.withColumn("suffix", _suffix(1)).join(found, "suffix", "left")
            escape = F.when(F.col("others") > 0, F.log10("others") - F.log10(rest)).otherwise(0.0)
            below = F.when(F.col("n_shorter").isNotNull(), F.log10("n_shorter") - F.log10(rest)).otherwise(escape + F.col("below_shorter"))
            fresh = F.col("fresh_shorter")
        own = own.select("gram", "n", "total", "distinct", below.alias("below"), fresh.alias("fresh"))
        fresh = F.when(F.col("n").isNotNull(), F.log10("n") - F.log10(all_)).when(F.col("total").isNotNull(), F.log10("distinct") - F.log10(all_) + F.col("below")).otherwise(F.col("fresh"))
        found = own.select(F.col("gram").alias("suffix"), F.col("n").alias("n_shorter"), F.col("below").alias("below_shorter"), fresh.alias("fresh_shorter"))
    unseen = longest.filter(~known).select("gram", "uses").join(found.select(F.col("suffix").alias("gram"), F.col("fresh_shorter").alias("value")), "gram")
    return stored(seen.unionByName(unseen), "gram-values")


def _worker_model(key: str, load) -> tuple[Table, np.ndarray, dict[bytes, int], np.ndarray]:
    """The worker's model, kept from task to task until the worker needs another one or another operator's."""

    def make():
        grams, values, words, word_counts = load.value
        return Table(grams), np.append(values, 0.0), dict(zip(words, range(len(words)))), np.append(np.log10(word_counts + 1.0), 0.0)

    return kept_by_worker(("ppm", key), make)


SCORED = (
    "shard int, row long, doc_id long, held_out boolean, n_tokens long, known long, log_counts double, score double, "
    "rare array<struct<word:string,n:long>>, rare_grams array<struct<gram:long,n:long>>"
)


def _rare_grams(keys: np.ndarray, owners: np.ndarray, texts: int) -> pa.ListArray:
    """For each text its distinct ``keys`` with their counts."""
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1]))) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(heads, len(keys)))
    offsets = np.searchsorted(owners[heads], np.arange(texts + 1))
    pairs = pa.StructArray.from_arrays([pa.array(keys[heads].astype(np.int64)), pa.array(counts.astype(np.int64))], ["gram", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def _score(key: str, load, order: int):
    def run(batches):
        grams, values, words, logs = _worker_model(key, load)
        shard, row = TaskContext.get().partitionId(), 0
        kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
        for batch, texts in slices(batches, chars=PART_CHARS):
            raws = [normal(t) for t in texts]
            keys, sizes = contexts(raws, order)
            borders = np.concatenate([[0], np.cumsum(sizes)])
            found = grams.find(keys)
            scores = np.add.reduceat(values[found], borders[:-1])
            beyond = np.flatnonzero(found < 0)
            rare_grams = _rare_grams(keys[beyond], np.searchsorted(borders, beyond, "right") - 1, len(texts))
            tokens, known, sums, rare = [], [], [], []
            for raw in raws:
                own = raw.split()
                at = np.fromiter(map(words.get, own, repeat(-1)), np.int64, len(own))
                missing = np.flatnonzero(at < 0)
                tokens.append(len(own) + 1)
                known.append(len(own) - len(missing))
                sums.append(float(logs[at].sum()))
                rare.append([{"word": w.decode(), "n": n} for w, n in Counter([own[i] for i in missing.tolist()]).items()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(texts), shard, np.int32)), pa.array(np.arange(row, row + len(texts))), batch.column("doc_id"), batch.column("held_out"),
                 pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(scores), pa.array(rare, kind), rare_grams],
                ["shard", "row", "doc_id", "held_out", "n_tokens", "known", "log_counts", "score", "rare", "rare_grams"],
            )
            row += len(texts)

    return run


def score(
    docs: DataFrame, parts: int = 7, held_out: int = 2, order: int = 5, most_grams: int | None = None, most_words: int = 100_000, cached_grams: int = 1_000_000
) -> DataFrame:
    """One row per document: the model's and the baseline's log10 probability, learned outside fold ``held_out``.

    ``cached_grams`` and ``most_words`` (the most frequent) go through the driver to all tasks and bound nothing else. The model has all
    n-grams of the training texts, or the ``most_grams`` most frequent ones.
    """
    spark = docs.sparkSession
    texts = texts_of(docs, (fold(parts) == held_out).alias("held_out"))
    training = texts.filter(~F.col("held_out")).select("text")
    words = stored(training.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    others = texts.filter("held_out").select("text").mapInArrow(_count_grams(order), "gram long, n long")
    longest = training.mapInArrow(_count_grams(order), "gram long, n long").select("gram", "n", F.col("n").alias("uses"))
    longest = longest.unionByName(others.select("gram", F.lit(0).cast("long").alias("n"), F.col("n").alias("uses")))
    longest = stored(longest.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")), "byte-grams")
    learned = longest.filter("n > 0")
    grams = learned.select("gram", F.lit(order + 1).alias("length"), "n")
    for length in range(order, 0, -1):
        shorter = learned.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * length) - 1)).alias("gram")).agg(F.sum("n").alias("n"))
        grams = grams.unionByName(shorter.select("gram", F.lit(length).alias("length"), "n"))
    grams = stored(grams, "all-grams")
    least = 1 if most_grams is None else least_count(grams, most_grams)
    valued = log_probabilities(longest, grams.filter(F.col("n") >= least), order, least)
    cached = valued.filter(F.col("uses") >= least_count(valued.select(F.col("uses").alias("n")), cached_grams)).select("gram", "value").toArrow()
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("distinct")).first()
    ends = training.count()
    n, distinct = totals.n + ends, totals.distinct + (1 if ends else 0)
    frequent = words.filter(F.col("n") >= least_count(words, most_words)).toArrow()
    load = spark.sparkContext.broadcast((
        cached.column("gram").to_numpy().astype(np.uint64), cached.column("value").to_numpy(),
        [w.encode() for w in frequent.column("word").to_pylist()], frequent.column("n").to_numpy(),
    ))
    scored = stored(texts.mapInArrow(_score(uuid.uuid4().hex, load, order), SCORED), "scored")
    rare = scored.select("shard", "row", F.explode("rare").alias("r")).select("shard", "row", F.col("r.word").alias("word"), F.col("r.n").alias("times"))
    found = rare.join(words, "word").groupBy("shard", "row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs")
    )
    beyond = scored.select("shard", "row", F.explode("rare_grams").alias("r")).select("shard", "row", "r.gram", F.col("r.n").alias("times"))
    added = beyond.join(valued.select("gram", "value"), "gram").groupBy("shard", "row").agg(F.sum(F.col("times") * F.col("value")).alias("more_score"))
    end_log = float(np.log10(ends + 1.0))
    return scored.drop("rare", "rare_grams").join(found, ["shard", "row"], "left").join(added, ["shard", "row"], "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.coalesce("more_logs", F.lit(0.0)) + end_log - F.col("n_tokens") * float(np.log10(n + distinct + 1.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


@query("op6_ppm")
def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))

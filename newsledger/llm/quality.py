"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its words (and whether each repeats the one before) and of its character n-grams, hashed to buckets; a softmax layer on top gives
the class. Vectors and layer are trained together in numpy by stochastic gradient descent on a bounded sample of labelled rows
(``Settings.per_class`` per class, whole texts). As the mean and the layer are linear, each bucket's contribution to the log
odds is one number when the model is applied, and whole texts are scored by hashing and gathering alone.

Cases: null text is empty; a text without features has the score of the bias alone; null ids are in no fold but 0; repeated ids keep all
their rows; without labels of both classes every score is the smoothed share of class 1; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.labelled import sample_texts, training_rows
from newsledger.llm.shared import documents, fold, labels, release_worker, texts_of

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3
INVERSE = pow(BASE, -1, 1 << 64)
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PART = 500_000


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled rows that are learned from; the rest sizes the model."""

    per_class: int = 1500
    buckets: int = 1 << 16
    dimensions: int = 8
    grams: tuple[int, ...] = (3, 4)
    updates: int = 900
    rate: float = 0.3
    batch: int = 32


def powers(base: int, count: int) -> np.ndarray:
    """``base ** 0, 1, 2 ...`` modulo 2 ** 64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span of bytes, whatever lies around it."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), dtype=np.uint64)])
    return (sums[ends] - sums[starts]) * powers(INVERSE, len(raw) + 1)[starts]


def features(texts: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all features in document order, and the number of features per text."""
    raws = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    shift = np.uint64(64 - settings.buckets.bit_length() + 1)
    space = SPACES[raw]
    edges = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    words = word_hashes(raw, starts, stops)
    owner = np.searchsorted(ends, starts, side="right")
    # A word and the one before it also give a feature of their shape: the same again, or another.
    again = np.full(len(words), 2, np.uint64)
    again[1:][(words[1:] == words[:-1]) & (owner[1:] == owner[:-1])] = 1
    found = [((x * MULTIPLIER) >> shift).astype(np.int32) for x in (words, again)]
    owners = [owner, owner]
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    of_point = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    for n in settings.grams:
        if len(points) < n:
            continue
        key = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            key = key * np.uint64(BASE) + points[k:len(points) - n + 1 + k]
        inside = of_point[:len(key)] == of_point[n - 1:]
        found.append(((key[inside] * MULTIPLIER) >> shift).astype(np.int32))
        owners.append(of_point[:len(key)][inside])
    return np.concatenate(found), np.concatenate(owners)


def _sample_features(settings: Settings):
    """Rows ``(doc_id, y, text)`` to sparse means: the buckets of a text and their shares."""

    def run(batches):
        release_worker()
        for batch in batches:
            for doc_id, y, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "y", "text"))):
                buckets, counts = np.unique(features([text], settings)[0], return_counts=True)
                shares = (counts / max(1, counts.sum())).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id]), pa.array([y], pa.int32()), pa.array([buckets.astype("<i4").tobytes()]), pa.array([shares.astype("<f4").tobytes()])],
                    ["doc_id", "y", "buckets", "shares"],
                )

    return run


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], log_odds: float, settings: Settings) -> tuple[np.ndarray, float]:
    """Contribution of each bucket to the log odds of class 1, and the bias, from ``(y, buckets, shares)`` rows.

    Both classes weigh alike, whatever their numbers; with one class only, ``log_odds`` is all there is.
    """
    random = np.random.default_rng(7)
    y = np.array([r[0] for r in rows], np.float64)
    if len(set(y)) < 2:
        return np.zeros(settings.buckets, np.float32), log_odds
    vectors = random.normal(0, 0.1, (settings.buckets, settings.dimensions))
    layer = random.normal(0, 0.1, (settings.dimensions, 2))
    bias, weight = np.zeros(2), np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    squares, layer_squares = np.full(settings.buckets, 1e-8), 1e-8
    for _ in range(-(-settings.updates * settings.batch // len(rows))):
        order = random.permutation(len(rows))
        for k in range(0, len(rows), settings.batch):
            part = order[k:k + settings.batch]
            buckets = np.concatenate([rows[i][1] for i in part])
            shares = np.concatenate([rows[i][2] for i in part]).astype(np.float64)
            owner = np.repeat(np.arange(len(part)), [len(rows[i][1]) for i in part])
            means = np.stack([np.bincount(owner, shares * vectors[buckets, d], len(part)) for d in range(settings.dimensions)], axis=1)
            logits = means @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            error = p.copy()
            error[np.arange(len(part)), y[part].astype(int)] -= 1
            error *= weight[part, None]
            to_means = error @ layer.T
            gradient = np.zeros_like(vectors)
            for d in range(settings.dimensions):
                gradient[:, d] = np.bincount(buckets, shares * to_means[owner, d], settings.buckets)
            squares += (gradient ** 2).mean(1)
            vectors -= settings.rate * gradient / np.sqrt(squares)[:, None]
            to_layer = means.T @ error / len(part)
            layer_squares += (to_layer ** 2).mean()
            layer -= settings.rate * 0.1 * to_layer / np.sqrt(layer_squares)
            bias -= 0.02 * error.mean(0)
    contribution = vectors @ (layer[:, 1] - layer[:, 0])
    return contribution.astype(np.float32), float(bias[1] - bias[0])


@dataclass(frozen=True)
class Model:
    contribution: np.ndarray
    bias: float
    settings: Settings

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability of class 1 for each text."""
        out = []
        start = 0
        while start < len(texts):
            part, size = [], 0
            while start < len(texts) and size < PART:
                part.append(texts[start])
                size += len(part[-1])
                start += 1
            buckets, owners = features(part, self.settings)
            sums = np.bincount(owners, self.contribution[buckets], len(part))
            counts = np.bincount(owners, minlength=len(part))
            out.append(1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + self.bias))))
        return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", parts: int = 5, held_out: int = 0, settings: Settings = Settings()) -> Model:
    """The model learned from the labelled rows of ``docs`` outside fold ``held_out`` of ``parts``."""
    sample, log_odds = training_rows(labels, column, parts, held_out, settings.per_class)
    table = sample_texts(docs, sample).mapInArrow(_sample_features(settings), "doc_id long, y int, buckets binary, shares binary").toArrow()
    table = table.sort_by([(c, "ascending") for c in ("doc_id", "y", "buckets", "shares")])
    rows = [
        (y, np.frombuffer(b, "<i4"), np.frombuffer(s, "<f4"))
        for y, b, s in zip(*(table.column(c).to_pylist() for c in ("y", "buckets", "shares")))
    ]
    return Model(*fit(rows, log_odds, settings), settings)


def scorer(model):
    """A column function: the model's score of a text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        release_worker()
        return pa.array(model.score(["" if t is None else t for t in texts.to_pylist()]), pa.float64())

    return score


def keep_good(docs: DataFrame, model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns."""
    return docs.withColumn("_newsledger_score", scorer(model)("text")).filter(F.col("_newsledger_score") >= threshold).drop("_newsledger_score")


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, labels(spark, sf_dir))
    scored = texts_of(docs).select("doc_id", (fold(5) == 0).alias("held_out"), scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))

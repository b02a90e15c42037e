"""Toxicity: a counterfactual-regularised classifier.

A document is the set of its words and word beginnings; a sparse logistic model scores it. Besides fitting the labels, training
swaps identity terms in labelled sentences for others of their kind and penalises the change of the score, so that
mentioning a group weighs little by itself. The model is learned in numpy by proximal gradient steps (an L1 term leaves a few thousand
weights at most) on a bounded sample of labelled rows (``Settings.per_class`` per class, whole texts). Features are 64-bit hashes,
looked up by value, so other words do not share a weight. Every word of a text counts, however long the text.

Cases: null text is empty; a text without known features has the score of the bias alone; null ids are in no fold but 0; repeated ids keep
all their rows; without labels of both classes every score is the smoothed share of class 1; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.labelled import sample_texts, training_rows
from newsledger.llm.quality import MULTIPLIER, PART, scorer, word_hashes
from newsledger.llm.shared import documents, fold, labels, texts_of

# Groups of terms that may stand for each other in a sentence, by language.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male", "transgender", "nonbinary"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "queer"), ("black", "white", "asian", "latino", "arab"),
    ("immigrant", "refugee", "foreigner", "native"), ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "deaf", "blind"), ("old", "young"), ("african", "european", "american", "mexican", "chinese", "indian"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés", "étrangers"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("einwanderer", "flüchtlinge", "ausländer"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados", "extranjeros"),
)
_SWAPS = {term: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, term in enumerate(group)}
_TERM = re.compile(r"(?<!\w)(" + "|".join(sorted(_SWAPS, key=len, reverse=True)) + r")(?!\w)")
_SENTENCE = re.compile(r"[^.!?\n]+")
_IN_WORD = np.isin(np.arange(256), [*range(48, 58), *range(97, 123), *range(128, 256)])
BEGINNINGS = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled rows that are learned from, ``features`` the weights that are tried."""

    per_class: int = 2500
    features: int = 20_000
    least_texts: int = 3
    sparsity: float = 3e-4
    swap_penalty: float = 1.0
    steps: int = 300


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit features of all words (the word, and its first 4, 5 and 6 bytes) and the text that each belongs to."""
    raws = [t.lower().encode() for t in texts]
    raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    edges = np.diff(np.concatenate([[False], _IN_WORD[raw]]).astype(np.int8))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(ends, starts, side="right")
    found, owners = [word_hashes(raw, starts, stops) * MULTIPLIER], [owner]
    for n in BEGINNINGS:
        long = stops - starts > n
        found.append((word_hashes(raw, starts[long], starts[long] + n) + np.uint64(n)) * MULTIPLIER)
        owners.append(owner[long])
    return np.concatenate(found), np.concatenate(owners)


def swapped(text: str) -> tuple[list[str], list[str]]:
    """The sentences of a text that hold identity terms, and the same with each term swapped."""
    sentences = [s for s in _SENTENCE.findall(text.lower()) if _TERM.search(s)]
    return sentences, [_TERM.sub(lambda m: _SWAPS[m[1]], s) for s in sentences]


def _sample_features(batches):
    """Rows ``(doc_id, y, text)`` to the distinct features of the text and those by which its swapped sentences differ."""
    for batch in batches:
        for doc_id, y, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "y", "text"))):
            own = np.unique(features([text])[0])
            before, after = swapped(text)
            pairs = []
            for a, b in zip(before, after):
                x, z = np.unique(features([a])[0]), np.unique(features([b])[0])
                pairs.append((np.setdiff1d(x, z), np.setdiff1d(z, x)))
            plus = [p[0].astype("<u8").tobytes() for p in pairs]
            minus = [p[1].astype("<u8").tobytes() for p in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id]), pa.array([y], pa.int32()), pa.array([own.astype("<u8").tobytes()]), pa.array([plus], pa.list_(pa.binary())), pa.array([minus], pa.list_(pa.binary()))],
                ["doc_id", "y", "features", "plus", "minus"],
            )


def _matrix(rows: list[np.ndarray], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the known features in each row."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
    hit = known[at] == flat
    return owner[hit], at[hit]


def fit(rows: list[tuple[int, np.ndarray]], swaps: list[tuple[np.ndarray, np.ndarray]], log_odds: float, settings: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """Sorted features with their weights, and the bias, from ``(y, features)`` rows and swapped feature differences."""
    y = np.array([r[0] for r in rows], np.float64)
    empty = np.zeros(0, np.uint64), np.zeros(0, np.float32)
    if len(set(y)) < 2:
        return *empty, log_odds
    values, total = np.unique(np.concatenate([r[1] for r in rows]), return_counts=True)
    values, total = values[total >= settings.least_texts], total[total >= settings.least_texts]
    if not len(values):
        return *empty, log_odds
    row, column = _matrix([r[1] for r in rows], values)
    toxic, share = np.bincount(column, y[row], len(values)), y.mean()
    strength = np.abs(toxic - total * share) / np.sqrt(total * share * (1 - share))
    chosen = np.sort(np.argsort(-strength, kind="stable")[:settings.features])
    known = values[chosen[strength[chosen] > 0]]
    if not len(known):
        return *empty, log_odds
    row, column = _matrix([r[1] for r in rows], known)
    plus, minus = _matrix([s[0] for s in swaps], known), _matrix([s[1] for s in swaps], known)
    swap_row, swap_column = np.concatenate([plus[0], minus[0]]), np.concatenate([plus[1], minus[1]])
    sign = np.concatenate([np.ones(len(plus[0])), -np.ones(len(minus[0]))])
    n, w, bias = len(rows), np.zeros(len(known)), float(np.log(share / (1 - share)))
    # Steps scaled by each feature's frequency: common features move slowly, rare ones fast.
    scale = 0.5 * np.bincount(column, minlength=len(known)) / n
    scale += settings.swap_penalty * np.bincount(swap_column, minlength=len(known)) * 2 / max(1, len(swaps))
    rate = 0.2 / np.maximum(scale, 1e-4)
    for _ in range(settings.steps):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[column], n) + bias)))
        error = (p - y) / n
        gradient = np.bincount(column, error[row], len(known))
        if len(swaps):
            change = np.bincount(swap_row, sign * w[swap_column], len(swaps))
            gradient += settings.swap_penalty * 2 / len(swaps) * np.bincount(swap_column, sign * change[swap_row], len(known))
        w = w - rate * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - rate * settings.sparsity, 0)
        bias -= error.sum()
    kept = np.abs(w) > 1e-6

    return known[kept], w[kept].astype(np.float32), bias


@dataclass(frozen=True)
class Model:
    known: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability that a text is toxic, for each text."""
        out = []
        start = 0
        gate = np.zeros(1 << 20, bool)
        gate[(self.known >> np.uint64(44)).astype(np.int64)] = True
        while start < len(texts):
            part, size = [], 0
            while start < len(texts) and size < PART:
                part.append(texts[start])
                size += len(part[-1])
                start += 1
            found, owner = features(part)
            near = np.flatnonzero(gate[(found >> np.uint64(44)).astype(np.int64)])
            found, owner = found[near], owner[near]
            sums = np.zeros(len(part))
            if len(self.known) and len(found):
                at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
                hit = self.known[at] == found
                once = np.unique(owner[hit] * len(self.known) + at[hit])
                sums = np.bincount(once // len(self.known), self.weights[once % len(self.known)], len(part))
            out.append(1 / (1 + np.exp(-(sums + self.bias))))
        return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", parts: int = 4, held_out: int = 2, settings: Settings = Settings()) -> Model:
    """The model learned from the labelled rows of ``docs`` outside fold ``held_out`` of ``parts``."""
    sample, log_odds = training_rows(labels, column, parts, held_out, settings.per_class)
    schema = "doc_id long, y int, features binary, plus array<binary>, minus array<binary>"
    table = sample_texts(docs, sample).mapInArrow(_sample_features, schema).toArrow()
    table = table.sort_by([(c, "ascending") for c in ("doc_id", "y", "features")])
    rows = [(y, np.frombuffer(f, "<u8")) for y, f in zip(table.column("y").to_pylist(), table.column("features").to_pylist())]
    swaps = [
        (np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"))
        for plus, minus in zip(table.column("plus").to_pylist(), table.column("minus").to_pylist()) for a, b in zip(plus, minus)
    ]
    return Model(*fit(rows, swaps, log_odds, settings))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns."""
    return docs.withColumn("_newsledger_score", scorer(model)("text")).filter(F.col("_newsledger_score") < threshold).drop("_newsledger_score")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, labels(spark, sf_dir))
    scored = texts_of(docs).select("doc_id", (fold(4) == 2).alias("held_out"), scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))

"""The classifiers against versions in plain Python, and every pipeline stage on rows that are odd or missing."""

import math
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import frame, rows  # noqa: E402

import corpus_pipeline  # noqa: E402
from newsledger.llm import quality, toxicity  # noqa: E402
from newsledger.llm.shared import documents, labels  # noqa: E402

MIDDLE = "/root/testdata/sf0.01"
ALL = (1 << 64) - 1
TEXTS = ["", " ", "a", "é", "日本語 日本語", "one one two", "two", "x" * 5000, "\U0001d518 \U0001d518\n\nb\x00", "Tail word", "word tail", "women and MEN met; idiots"]


def plain_hash(word):
    return sum((b + 1) * pow(quality.BASE, i, 1 << 64) for i, b in enumerate(word)) & ALL


def mixed(x):
    return x * int(quality.MULTIPLIER) & ALL


def plain_quality(model, text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode())
    found = [plain_hash(w) for w in words] + [1 if i and w == words[i - 1] else 2 for i, w in enumerate(words)]
    for n in model.settings.grams:
        points = [ord(c) + 1 for c in text + "\n"]
        for i in range(len(points) - n + 1):
            key = n
            for p in points[i:i + n]:
                key = (key * quality.BASE + p) & ALL
            found.append(key)
    bits = model.settings.buckets.bit_length() - 1
    mean = sum(float(model.contribution[mixed(f) >> (64 - bits)]) for f in found) / max(1, len(found))
    return 1 / (1 + math.exp(-(mean + model.bias)))


def plain_toxicity(model, text):
    weights, found = dict(zip(model.known.tolist(), model.weights.tolist())), set()
    for word in re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode()):
        found.add(mixed(plain_hash(word)))
        found |= {mixed(plain_hash(word[:n]) + n & ALL) for n in toxicity.BEGINNINGS if len(word) > n}
    return 1 / (1 + math.exp(-(sum(weights.get(f, 0.0) for f in found) + model.bias)))


@pytest.fixture(scope="module")
def models(spark):
    docs, marks = documents(spark, MIDDLE), labels(spark, MIDDLE)
    return {
        "quality": (quality.train(docs, marks), plain_quality, quality.keep_good, lambda s: s >= 0.3),
        "toxic": (toxicity.train(docs, marks), plain_toxicity, toxicity.keep_clean, lambda s: s < 0.3),
    }


@pytest.mark.parametrize("column", ["quality", "toxic"])
def test_scores_equal_the_plain_version(spark, models, column):
    model, plain, keep, accepted = models[column]
    texts = TEXTS + [r.text for r in documents(spark, MIDDLE).select("text").orderBy("doc_id").limit(120).collect()]
    want = [plain(model, t) for t in texts]
    assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(model.score(texts), want))
    assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(model.score(texts[::-1])[::-1], want))
    # Nulls, empty and long texts, repeated rows, clashing names.
    docs = frame(spark)
    left = Counter((r.doc_id, r.text) for r in keep(docs, model).collect())
    assert left == Counter((i, t) for i, t in rows() if accepted(plain(model, t or "")))
    assert keep(docs, model).columns == docs.columns and keep(frame(spark, []), model).count() == 0


def test_a_score_does_not_depend_on_other_texts(models):
    model = models["quality"][0]
    assert model.score(["ends with word", "word begins"])[1] == pytest.approx(model.score(["word begins"])[0], abs=1e-12)


def test_every_stage_takes_odd_and_missing_rows(spark):
    stages = corpus_pipeline.STAGES
    for name, stage in stages:
        assert stage(spark, frame(spark, []), "/root/testdata/sf0.001").count() == 0, name
        done = stage(spark, frame(spark), "/root/testdata/sf0.001").collect()
        assert name == stages[-1][0] or {(r.doc_id, r.text) for r in done} <= set(rows()), name

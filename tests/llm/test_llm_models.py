import math
import random
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).parent))
from cases import frame  # noqa: E402

from newsledger.llm import ppm, quality, toxicity  # noqa: E402
from newsledger.llm.shared import documents, fold, labels  # noqa: E402

MIDDLE = "/root/testdata/sf0.01"
NO_LABELS = "doc_id long, quality int, toxic int, text string"


def held_out_errors(docs, marks, parts, fold_no, model, column):
    rows = docs.join(marks, "doc_id").filter(fold(parts) == fold_no).select("text", column).collect()
    scores = model.score([r.text for r in rows])
    truth = np.array([r[column] for r in rows])
    return ((scores >= 0.3) != (truth == 1)), truth


def test_quality_on_held_out_rows(spark):
    docs, marks = documents(spark, MIDDLE), labels(spark, MIDDLE)
    model = quality.train(docs, marks)
    wrong, truth = held_out_errors(docs, marks, 5, 0, model, "quality")
    assert wrong.mean() < 0.08 and not wrong[truth == 1].any()
    kept = quality.keep_good(frame(spark), model)
    assert kept.columns == frame(spark).columns and set(r.doc_id for r in kept.collect()) <= set(r.doc_id for r in frame(spark).collect())
    assert all(0 <= s <= 1 for s in model.score(["", " ", "a", "x" * 3_000_000]))
    assert quality.keep_good(frame(spark, []), model).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, marks = documents(spark, "/root/testdata/sf0.1"), labels(spark, "/root/testdata/sf0.1")
    model = toxicity.train(docs, marks)
    wrong, truth = held_out_errors(docs, marks, 4, 2, model, "toxic")
    assert wrong.mean() < 0.03 and wrong[truth == 0].mean() < 0.01
    assert all(0 <= s <= 1 for s in model.score(["", " ", "idiot", "x" * 3_000_000]))
    assert model.score(["fine words " * 20_000 + " you worthless idiot scum"])[0] > 0.3
    assert toxicity.keep_clean(frame(spark), model).columns == frame(spark).columns


def test_classifiers_without_labels(spark):
    none = spark.createDataFrame([(1, None, None, "x"), (None, 1, 1, "x"), (3, 1, 0, "x")], NO_LABELS)
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        scores = module.train(frame(spark), none, column).score(["", "a b"])
        assert len(set(scores)) == 1 and 0 < scores[0] < 1


def test_swapping_identity_terms_changes_scores_less_with_the_penalty():
    before, after = toxicity.swapped("Those women are here. Nothing else! Old men")
    assert before == ["those women are here", " old men"] and after == ["those men are here", " young girls"]
    toxic = [f"muslims are stupid idiots {k}" for k in range(30)] + [f"you idiot number {k}" for k in range(30)]
    clean = [f"christians met today {k}" for k in range(40)] + [f"a good day {k}" for k in range(40)]
    rows = [(y, np.unique(toxicity.features([t])[0])) for y, texts in ((1, toxic), (0, clean)) for t in texts]
    swaps = []
    for t in toxic + clean:
        for a, b in zip(*toxicity.swapped(t)):
            x, z = np.unique(toxicity.features([a])[0]), np.unique(toxicity.features([b])[0])
            swaps.append((np.setdiff1d(x, z), np.setdiff1d(z, x)))
    gaps = []
    for penalty in (0.0, 5.0):
        model = toxicity.Model(*toxicity.fit(rows, swaps, 0.0, toxicity.Settings(swap_penalty=penalty)))
        scores = model.score(["muslims met today", "christians met today", "you idiot"])
        gaps.append(abs(scores[0] - scores[1]))
        assert scores[2] > 0.5
    assert gaps[1] < gaps[0] / 2


def plain_ppm(train, texts, order):
    counts = defaultdict(Counter)
    for text in train:
        coded = [255] * order + list(ppm.normal(text)) + [255]
        for i in range(order, len(coded)):
            for k in range(order + 1):
                counts[tuple(coded[i - k:i])][coded[i]] += 1
    out = []
    for text in texts:
        coded, total = [255] * order + list(ppm.normal(text)) + [255], 0.0
        for i in range(order, len(coded)):
            excluded, symbol, found = set(), coded[i], False
            for k in range(order, -1, -1):
                left = {s: n for s, n in counts.get(tuple(coded[i - k:i]), {}).items() if s not in excluded}
                size, whole = len(left), sum(left.values())
                if symbol in left:
                    total += math.log10(left[symbol] / (whole + size))
                    found = True
                    break
                if size:
                    total += math.log10(size / (whole + size))
                excluded |= set(left)
            total -= 0 if found else math.log10(256 - len(excluded))
        out.append(total)
    return out


def test_ppm_equals_the_plain_algorithm(spark):
    docs = frame(spark, [(k, t) for k, t in enumerate([
        None, "", "hello world", "the cat sat on the mat", "the hat é", "abracadabra", "HELLO there", "zebra", "a\x00b", "the mat", "q w e", "the cat",
    ] * 2)])
    rows = {r.doc_id: r for r in ppm.score(docs, order=3).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    train = [t for i, t in texts.items() if not held[i]]
    words = Counter(w for t in train for w in [*ppm.normal(t).split(), None])
    total, distinct = sum(words.values()), len(words)
    for (i, text), want in zip(texts.items(), plain_ppm(train, texts.values(), 3)):
        own = [*ppm.normal(text).split(), None]
        base = sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in own)
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(words[w] > 0 for w in own), total)
        assert math.isclose(r.score, want, abs_tol=1e-9) and math.isclose(r.base_score, base, abs_tol=1e-9)


def test_ppm_with_few_words_sent_and_pruned_contexts(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    full = {r.doc_id: r for r in ppm.score(docs).collect()}
    small = {r.doc_id: r for r in ppm.score(docs, most_words=20, most_grams=3000).collect()}
    assert all(math.isclose(full[i].base_score, small[i].base_score, rel_tol=1e-9) and full[i].n_known == small[i].n_known for i in full)
    assert sum(r.score for r in small.values()) < sum(r.score for r in full.values()) < 0
    assert ppm.score(frame(spark, [])).count() == 0


def test_ppm_scores_from_all_grams_whatever_is_cached(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=60_000)) for _ in range(7)] + ["the mat", "qz the cat\u00e9", ""]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    want = plain_ppm([t for t, h in zip(texts, held) if not h], texts, 5)
    docs = frame(spark, list(enumerate(texts)))
    # More than a million n-grams in all: the model has no size of its own.
    for settings in ({}, {"cached_grams": 50}):
        rows = {r.doc_id: r.score for r in ppm.score(docs, **settings).collect()}
        assert all(math.isclose(rows[i], s, rel_tol=1e-9) for i, s in enumerate(want))


def test_gram_counts_lose_nothing_and_leave_in_pieces(monkeypatch):
    monkeypatch.setattr(ppm, "FLUSH", 2_000)
    monkeypatch.setattr(ppm, "PART_CHARS", 3_000, raising=False)
    monkeypatch.setattr(ppm, "GRAM_ROWS", 500, raising=False)
    draw = random.Random(8)
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz "):
        texts = ["".join(draw.choices(letters, k=400)) for _ in range(300)]
        batches = [pa.RecordBatch.from_arrays([pa.array(texts[k:k + 100])], ["text"]) for k in (0, 100, 200)]
        want = Counter(ppm.contexts([ppm.normal(t) for t in texts], 5)[0].astype(np.int64).tolist())
        got = Counter()
        for batch in ppm._count_grams(5)(iter(batches)):
            assert batch.num_rows <= 500
            for gram, n in zip(*(c.to_pylist() for c in batch.columns)):
                got[gram] += n
        assert got == want


def test_scoring_holds_little_besides_the_model(monkeypatch):
    draw = random.Random(9)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randrange(2, 9))) for _ in range(5000)]
    texts = [" ".join(draw.choices(words, k=1000)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array([False] * 600), pa.array(texts)], ["doc_id", "held_out", "text"])
    grams = np.unique(ppm.contexts([ppm.normal(texts[0])], 5)[0])
    model = ppm.Table(grams), np.append(np.full(len(grams), -1.0), 0.0), {}, np.zeros(1)
    monkeypatch.setattr(ppm, "_worker_model", lambda key, load: model)
    monkeypatch.setattr(ppm.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in ppm._score("key", None, 5)(iter([batch])))
        assert rows == 600 and tracemalloc.get_traced_memory()[1] < 90e6
    finally:
        tracemalloc.stop()

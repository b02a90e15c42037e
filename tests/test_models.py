import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsledger.functions import analysis as A
from newsledger.functions.vectors import is_usable, safe_vector
from newsledger.operators.enrich import attach_analysis, call_model, embed, enrich
from newsledger.operators.quality import contract_check
from newsledger.operators.search import vector_topk
from newsledger.plans import gap
from newsledger.plans.process import process_items

GOOD = {
    "summary": "s", "category": "總體經濟", "importance_score": 7, "target_roles": ["法遵長"], "sentiment_score": -2,
    "entities": [{"type": "org", "name": "n", "context": "c"}], "tags": ["a", "b"], "ai_summary": "報告主管，好",
}


def parsed(spark, *raws):
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    return [r.a for r in df.select("i", A.parse_analysis(F.col("raw")).alias("a")).orderBy("i").collect()]


def test_parse(spark):
    good, wrong, odd, empty, null = parsed(
        spark, json.dumps(GOOD), '{"importance_score": "8", "tags": "x", "entities": {"type": "org"}, "sentiment_score": "bad"}',
        '{"importance_score": 7.5, "summary": null, "tags": [1, "y"]}', "{}", ' {"summary": {"a": 1}} ',
    )
    assert good.importance_score == 7 and good.tags == ["a", "b"] and good.entities[0].name == "n"
    assert (wrong.importance_score, wrong.tags, wrong.entities, wrong.sentiment_score) == (8, [], [], None)
    assert (odd.importance_score, odd.summary, odd.tags) == (None, None, ["1", "y"])
    assert not empty.is_fallback and empty.importance_score is None and null.summary == '{"a":1}'
    for answer in parsed(spark, "oops", "[1]", "5", "", None, '{"a":', '{"a": 1} tail'):
        assert answer.is_fallback and answer.importance_score == 5 and answer.category == "未分類"
        assert answer.sentiment_score == 0.0 and answer.tags == [] and answer.entities == []


def test_validate(spark):
    raws = [
        json.dumps(GOOD),
        json.dumps({**GOOD, "category": "x", "importance_score": 11, "target_roles": ["x"], "sentiment_score": 6,
                    "tags": ["a"], "ai_summary": "報告主管" + "字" * 77}),
        "{}",
    ]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string").withColumn("a", A.parse_analysis(F.col("raw")))
    rows = df.select("i", *[c.alias(n) for n, c in A.validate_analysis(F.col("a")).items()]).orderBy("i").collect()
    assert all(rows[0][1:]) and not any(rows[1][1:])
    assert rows[2].roles_ok and not rows[2].category_ok and not rows[2].tags_ok


def test_prompt_takes_the_first_characters_if_asked(spark):
    df = spark.createDataFrame([("t", "字" * 3001 + "end"), (None, None)], "title string, body string")
    long, bare = [r.p for r in df.select(A.build_prompt(F.col("title"), F.col("body"), 3000).alias("p")).collect()]
    assert "<content>\n" + "字" * 3000 + "\n</content>" in long and "end" not in long
    assert "<content>\n\n</content>" in bare
    whole = df.select(A.build_prompt(F.col("title"), F.col("body")).alias("p")).first().p
    assert "字end\n</content>" in whole


def picky():
    def answer(texts):
        if any("bad" in t for t in texts):
            raise ValueError("no")
        return [json.dumps({**GOOD, "summary": f"on {t}"}) for t in texts]

    return answer


def test_failing_rows_stay_alone(spark):
    rows = [(i, None if i == 5 else "bad" if i % 7 == 0 else f"text{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(3)
    got = {r.i: r for r in enrich(df, "t", picky, batch_size=8).collect()}
    assert len(got) == 40
    for i, text in rows:
        row = got[i]
        if text is None:
            assert row.analysis is None and row.analysis_error is None
        elif text == "bad":
            assert row.analysis.is_fallback and row.analysis_error == "ValueError: no"
        else:
            assert row.analysis.summary == f"on {text}" and row.analysis_error is None
    broken = call_model(df, "t", lambda: (lambda texts: ["x"] * (len(texts) + 1)), "o", "e").filter("i = 1").first()
    assert broken.o is None and "answers" in broken.e


def test_vectors(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0]), (4, [1.0, float("nan")]), (5, [1.0, None])],
        "i int, v array<float>",
    )
    rows = {r.i: r.s for r in df.select("i", safe_vector(F.col("v"), 2).alias("s")).collect()}
    assert rows[0] == [1.0, 2.0]
    for i in range(1, 6):
        assert rows[i] == pytest.approx([1e-5, 1e-5])
    texts = spark.createDataFrame([("a",), ("fail",), (None,)], "t string")

    def factory():
        def vectors(ts):
            if "fail" in ts:
                raise RuntimeError("down")
            return [[float(len(t))] * 3 for t in ts]

        return vectors

    got = {r.t: r for r in embed(texts, "t", factory, dim=3).collect()}
    assert got["a"].embedding == [1.0] * 3 and got["fail"].embedding == pytest.approx([1e-5] * 3)
    assert "down" in got["fail"].embedding_error and got[None].embedding is None


def brute(queries, docs, k):
    out = {}
    for q, v in queries:
        v = np.asarray(v, float)
        sims = []
        for d, w in docs:
            w = np.asarray(w, float)
            norm = np.linalg.norm(v) * np.linalg.norm(w)
            sims.append((-(round(float(v @ w) / norm, 9) if norm else 0.0), d))
        out[q] = [d for _, d in sorted(sims)[:k]]
    return out


@pytest.mark.parametrize("max_values", [2**21, 40])
def test_vector_topk_equals_brute_force(spark, max_values):
    """Once with the queries sent to every task, once through the grid of cells."""
    rng = np.random.default_rng(3)
    docs = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(300)]  # many ties
    queries = [(f"q{i}", rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(25)] + [("zero", [0.0] * 4)]
    q = spark.createDataFrame(queries, "query_id string, vector array<float>")
    d = spark.createDataFrame(docs, "doc_id int, vector array<float>").repartition(5)
    got = {}
    for r in vector_topk(q, d, 3, max_values).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    assert got == brute(queries, docs, 3)
    assert vector_topk(q.limit(0), d).count() == 0
    assert vector_topk(q.limit(1), d.limit(2), 3, max_values).count() == 2


def test_gap_report(spark):
    regs = spark.createDataFrame([("r", "title", "summary", 9, [1.0, 0.0])], "reg_id string, title string, summary string, importance int, vector array<float>")
    docs = spark.createDataFrame(
        [(1, "far", [0.0, 1.0]), (2, "near", [1.0, 0.1]), (3, "nearest", [2.0, 0.0]), (4, "other", [-1.0, 0.0])],
        "doc_id int, text string, vector array<float>",
    )
    seen = gap.gap_report(regs, docs.select("doc_id", "vector"), docs.select("doc_id", "text"), lambda: (lambda ps: ps)).first()
    assert seen.title == "title" and seen.importance == 9 and seen.analysis_error is None
    assert "summary" in seen.analysis_result and "nearest\nnear\nfar" in seen.analysis_result
    assert gap.regulations_message(regs.limit(0)) == gap.NO_CHANGES and gap.regulations_message(regs) is None


def items(spark, *rows):
    from newsledger.operators.items import to_items

    return to_items(spark.createDataFrame(list(rows), "source string, title string, url string, body string"))


def test_process_policies(spark):
    raw = items(spark, ("s", "t1", "u1", "clean text"), ("s", "t2", "u2", "bad text"), ("s", "t3", "u3", "id C187654321 x" * 60))
    vectors = lambda: (lambda ts: [[float(len(t)), 1.0] for t in ts])
    have = spark.createDataFrame([("id-1", "法遵長")], "role_id string, role_name string")
    got = {r.title: r for r in process_items(raw, picky, vectors, dim=2, roles=have).collect()}
    assert got["t1"].is_analyzed and got["t1"].importance == 7 and got["t1"].category == "總體經濟"
    assert got["t1"].target_roles == ["id-1"] and got["t1"].embedding[0] == len("t1 " + got["t1"].summary)
    assert got["t2"].is_analyzed and got["t2"].category == "未分類" and "no" in got["t2"].analysis_error
    hit = got["t3"]
    assert not hit.is_analyzed and hit.importance == 10 and "C187654321" in hit.body and hit.analysis_error is None
    assert hit.embedding == pytest.approx([1e-5, 1e-5]) and hit.category == "scrape"
    silent = lambda: (lambda ts: ["{}" for _ in ts])
    masked = {r.title: r for r in process_items(raw, silent, vectors, "mask", dim=2, keep=False).collect()}
    assert masked["t3"].is_analyzed and "C187654321" not in masked["t3"].body
    assert "C187654321" not in masked["t3"].summary and len(masked["t3"].summary) == 600
    assert masked["t1"].importance is None  # the answer lacks it
    with pytest.raises(ValueError):
        process_items(raw, silent, vectors, "other")


def test_model_is_called_once_per_row(spark, tmp_path):
    def counting():
        def answer(ts):
            with open(f"{tmp_path}/calls", "a") as f:
                f.write("x" * len(ts))
            return ["{}" for _ in ts]

        return answer

    raw = items(spark, *[("s", f"t{i}", f"u{i}", "b") for i in range(20)])
    done = process_items(raw, counting, lambda: (lambda ts: [[1.0] for _ in ts]), dim=1)
    assert done.count() == 20 and done.filter("is_analyzed").count() == 20
    assert len((tmp_path / "calls").read_text()) == 20


def test_attach_leaves_unasked_rows(spark):
    raw = items(spark, ("s", "t", "u", "b")).withColumn("analysis", F.when(F.lit(False), A.parse_analysis(F.lit("{}"))))
    row = attach_analysis(raw).first()
    assert not row.is_analyzed and row.importance == 5 and row.analyzed_at is None and row.role_names == []


def test_contract(spark):
    good, short = "字" * 300, "字" * 299
    rows = [
        ("k1", good, good, [1.0, 0.0]), ("k2", short, good, [0.0, 0.0]), ("k2", good, short, None),
        ("k3", good + " C187654321", good, [1.0]), (None, None, None, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "dedup_key string, body string, summary string, embedding array<float>")
    got = {r.rule: r.n_failed for r in contract_check(df, dim=2).collect()}
    assert got == {"key_unique": 3, "body_long": 2, "summary_long": 2, "vector_usable": 3, "pii_free": 1}
    assert {r.n_failed for r in contract_check(df.limit(0), dim=2).collect()} == {0}


def _resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 2**20


def growing():
    """Vectors of many different numbers, the first of which is the worker's growth in MB since its first call."""
    before = []

    def vectors(texts):
        before.append(_resident_mb())
        return [[before[-1] - before[0], *np.arange(1.0, 768.0).tolist()] for _ in texts]

    return vectors


def test_answers_do_not_pile_up_in_a_task(spark):
    """One Arrow batch of many rows: answers go back to Spark as they come, nulls between them keep their place."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        texts = spark.range(20000, numPartitions=1).select("id", F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("t"))
        done = call_model(texts, "t", growing, "v", "e", "array<float>")
        wrong = (F.col("v").isNull() != (F.col("id") % 5 == 0)) | F.col("e").isNotNull() | (F.element_at("v", -1) != 767.0)
        got = done.agg(F.count("*").alias("n"), F.count_if(wrong).alias("wrong"), F.max(F.col("v")[0]).alias("mb")).first()
    finally:
        spark.conf.set(key, before)
    assert (got.n, got.wrong) == (20000, 0) and got.mb < 120


def test_usable_vectors_by_their_elements(spark):
    nan, inf = float("nan"), float("inf")
    cases = [([1.0, 0.0], True), ([0.0, -0.0], False), ([1.0, nan], False), ([inf, 1.0], False), ([-inf, 1.0], False), ([1.0, None], False),
             ([None, None], False), ([-1.0, -2.0], True), ([0.0, -3e38], True), ([1.0], False), ([], False), (None, False)]
    frame = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v array<float>")
    got = frame.select("i", is_usable(F.col("v"), 2).alias("ok")).orderBy("i").collect()
    assert [r.ok for r in got] == [ok for _, ok in cases]

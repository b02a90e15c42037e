import json

from pyspark.sql import functions as F

from newsledger.operators.enrich import embed, enrich
from newsledger.operators.items import to_items
from newsledger.plans.process import process_items
from newsledger.sources.answers import AnswerTable

TEXTS = ["a", "b", "a", "a", None, "", "bad", "bad", "c"]


def client(folder, refuse=("bad",)):
    """Notes every text that it is asked."""

    def make():
        def answer(texts):
            for t in texts:
                if t in refuse:
                    raise RuntimeError("refused")
            with open(f"{folder}/asked", "a") as out:
                out.writelines(f"{t}\n" for t in texts)
            return [json.dumps({"summary": f"s{t}"}) for t in texts]

        return answer

    return make


def asked(folder):
    path = folder / "asked"
    return sorted(path.read_text().split("\n")[:-1]) if path.exists() else []


def test_equal_texts_are_asked_once_and_never_again(spark, tmp_path):
    table = AnswerTable(spark, f"{tmp_path}/answers", "model/1 é")
    frame = spark.createDataFrame([(t, k) for k, t in enumerate(TEXTS)], "text string, key int").repartition(3)
    for refuse, errors in ((("bad",), 2), ((), 0), ((), 0)):
        got = {r.key: r for r in enrich(frame, "text", client(tmp_path, refuse), answers=table).collect()}
        assert len(got) == len(TEXTS) and sum(r.analysis_error is not None for r in got.values()) == errors
        for k, t in enumerate(TEXTS):
            assert (got[k].analysis is None) == (t is None)
            if t is not None and not (errors and t == "bad"):
                assert got[k].analysis.summary == f"s{t}" and got[k].analysis_error is None
    assert asked(tmp_path) == sorted(["a", "b", "", "c", "bad"])
    enrich(frame, "text", client(tmp_path, ()), answers=AnswerTable(spark, f"{tmp_path}/answers", "model/2")).collect()
    assert len(asked(tmp_path)) == 10  # another client has answers of its own


def test_nothing_to_ask(spark, tmp_path):
    table = AnswerTable(spark, f"{tmp_path}/answers", "m")
    none = spark.createDataFrame([(None,)], "text string")
    assert enrich(none, "text", client(tmp_path), answers=table).first().analysis is None
    assert enrich(none.limit(0), "text", client(tmp_path), answers=table).count() == 0 and not asked(tmp_path)


def test_vectors_and_the_whole_processing(spark, tmp_path):
    def vectors():
        return lambda texts: [[float(len(t))] * 768 for t in texts]

    rows = [("s", f"t{i % 2}", f"u{i}", f"body {i % 2}") for i in range(6)]
    items = to_items(spark.createDataFrame(rows, "source string, title string, url string, body string"))
    columns = ["url", "summary", "embedding", "analysis_error", "embedding_error", "is_analyzed"]
    plain = process_items(items, client(tmp_path), vectors, keep=False).select(columns)
    tables = {"answers": AnswerTable(spark, f"{tmp_path}/t", "a"), "vectors": AnswerTable(spark, f"{tmp_path}/t", "v")}
    for _ in range(2):
        kept = process_items(items, client(tmp_path), vectors, keep=False, **tables).select(columns)
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert tables["vectors"].rows("array<float>").count() == 2 and tables["answers"].rows().count() == 2
    assert embed(items, "body", vectors, answers=tables["vectors"]).filter(F.col("embedding")[0] != 6).count() == 0


def test_nothing_to_ask_asks_nothing(spark, tmp_path):
    """A run whose texts are all answered does not prepare a single text for the model."""
    table = AnswerTable(spark, str(tmp_path), "m")
    texts = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "x")], "key string, text string")

    def ask(frame):
        return frame.select("key", F.upper("text").alias("answer"), F.lit(None).cast("string").alias("error"))

    def refuse(frame):
        raise AssertionError("asked again")

    assert sorted(tuple(r)[:2] for r in table.ask(texts, ask, "string").collect()) == [("a", "X"), ("b", "Y")]
    assert sorted(tuple(r)[:2] for r in table.ask(texts, refuse, "string").collect()) == [("a", "X"), ("b", "Y")]

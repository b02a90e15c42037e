import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from cases import EXTRA, words  # noqa: E402

import corpus_pipeline
from newsledger.llm import QUERIES, load_all
from newsledger.llm.shared import documents, stored

SMALL = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = documents(spark, SMALL)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stored(stage(spark, kept, SMALL), "test-stage")
        assert kept.columns == docs.columns and kept.exceptAll(before).count() == 0
        if name == "exact_dedup":
            texts = {}
            for r in before.collect():
                texts[r.text] = max(r.doc_id, texts.get(r.text, -1))
            assert sorted(r.doc_id for r in kept.collect()) == sorted(texts.values())
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept.collect()}
    assert sum({r.doc_id: r.doc_tokens for r in packed}.values()) == sum(r.length for r in packed)


def test_every_operator_is_registered():
    load_all()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_near_dedup_leaves_one_row_of_each_group(spark):
    a, b, c = (words(seed, 300) for seed in (31, 32, 33))
    # Null ids only, one smallest id on several texts, and a null id besides another one.
    groups = [(a, None), (a + " x", None), (a + " y", None), (b, 5), (b + " x", 5), (b + " y", 5), (b, 6), (c, None), (c + " x", 9)]
    data = [(t, i, 0.5, "yes", k, k, k, 1, [k]) for k, (t, i) in enumerate(groups)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(data, EXTRA), SMALL).collect()
    assert len(kept) == 3 and sorted(str(r.doc_id) for r in kept) == ["5", "9", "None"]
    assert {r.text[:20] for r in kept} == {t[:20] for t in (a, b, c)}

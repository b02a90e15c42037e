import numpy as np
import pytest
from pyspark.sql import functions as F

from newsledger.operators import search
from newsledger.operators.cells import VectorCells
from newsledger.operators.search import vector_topk


def rows(found):
    return sorted(tuple(r) for r in found.collect())


def table(spark, name, vectors):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} long, vector array<double>")


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(20, 16))
    return [middles[i % 20] + rng.normal(scale=0.05, size=16) for i in range(1200)]


def test_same_rows_with_few_pairs(spark, clustered):
    documents, queries = table(spark, "doc_id", clustered), table(spark, "query_id", clustered[:90])
    cells = VectorCells(documents, centres=20)
    assert rows(cells.topk(queries, 4)) == rows(vector_topk(queries, documents, 4))
    assert 0 < cells.compared < 0.5 * 90 * 1200


def test_same_rows_without_clusters_and_in_small_parts(spark):
    rng = np.random.default_rng(8)
    vectors = list(rng.normal(size=(150, 8))) + [np.ones(8)] * 40 + [np.zeros(8)] * 2
    documents, queries = table(spark, "doc_id", vectors), table(spark, "query_id", vectors)
    cells = VectorCells(documents, centres=5, max_values=64)
    assert rows(cells.topk(queries, 3)) == rows(vector_topk(queries, documents, 3))


def test_gaps(spark):
    odd = [None, [1, float("nan")], [float("inf"), 1], [1], [1, 2], [2, 1], [0, 0]]
    documents = table(spark, "doc_id", odd)
    cells = VectorCells(documents)
    found = rows(cells.topk(table(spark, "query_id", [[1, 2], None, [1, 2, 3], [0, 0], [1, 2]]), 9))
    assert [(q, r, d) for q, r, d, _ in found] == [
        (0, 1, 4), (0, 2, 5), (0, 3, 6), (3, 1, 4), (3, 2, 5), (3, 3, 6), (4, 1, 4), (4, 2, 5), (4, 3, 6)
    ]
    nothing = cells.topk(documents.limit(0).withColumnRenamed("doc_id", "query_id"))
    assert rows(nothing) == [] and nothing.columns == ["query_id", "rank", "doc_id", "similarity"]
    empty = VectorCells(documents.limit(0))
    assert rows(empty.topk(table(spark, "query_id", [[1, 2]]))) == []
    assert empty.cells == []


def test_nearest_equals_full_ranking_with_ties_and_unequal_ids():
    rng = np.random.default_rng(3)
    docs = search._unit_rows(list(np.concatenate([rng.integers(-2, 3, (3000, 6)), np.zeros((3, 6)), rng.normal(size=(500, 6)), np.full((2, 6), np.nan)])))
    queries, ids = search._unit_rows(list(docs[::5][:-1])), rng.permutation(len(docs)).astype(object)
    got = search._k_best(queries, ids, docs, 4)
    finite = np.flatnonzero(np.isfinite(docs).all(axis=1))
    sims = np.round(queries @ docs[finite].T, search.SIMILARITY_DIGITS) + 0.0
    for row, (found, at) in zip(sims, got):
        want = np.lexsort((ids[finite].astype(int), -row))[:4]
        assert np.allclose(found, row[want], atol=2e-9) and list(at) == list(ids[finite][want])


def test_small_cells_do_not_copy_documents_to_many_blocks(spark, monkeypatch):
    asked, grid = [], search._nearest_in_grid
    monkeypatch.setattr(search, "_nearest_in_grid", lambda *a: asked.append(a[4:]) or grid(*a))
    vectors = spark.range(300).select("id", F.array(*[(F.col("id") * 7 % (k + 3)).cast("float") for k in range(16)]).alias("vector"))
    left, right = vectors.withColumnRenamed("id", "query_id"), vectors.withColumnRenamed("id", "doc_id")
    small = search.vector_topk(left, right, 3, max_values=16)
    assert {tuple(r) for r in small.collect()} == {tuple(r) for r in search.vector_topk(left, right, 3).collect()}
    (blocks, slices), = asked
    assert blocks <= search.FEW_BLOCKS and slices <= search.FEW_BLOCKS

"""Keyword queries and exact nearest vectors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger.operators.ranking import first_per_group
from newsledger.operators.roles import role_filter as by_role
from newsledger.session import materialize
from newsledger.sources.title_index import TitleIndex

QUERY_COLUMNS = ("title", "summary", "importance", "category", "published_at", "url")
# Most numbers (query vectors times dimension) sent to every task: 16 MiB of doubles.
MAX_BROADCAST_VALUES = 2 * 1024 * 1024
MAX_SIMILARITIES = 4 * 1024 * 1024
SIMILARITY_DIGITS = 9
# Queries compared at once with a slice of documents, and blocks of queries up to which cells of the grid stay as small as they may be.
ROWS, FEW_BLOCKS = 512, 32


def title_ilike(items: DataFrame, query: str | None, index: TitleIndex | None = None) -> DataFrame:
    """Case-insensitive substring on the title; ``%`` and ``_`` in ``query`` stay wildcards.

    A backslash takes the next character literally, whichever it is. ``index`` (of these items' titles) narrows the rows
    before their titles are compared; the result is the same.
    """
    if not query:
        return items
    pattern = re.sub(r"(?s)\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], f"%{query}%")
    if index is not None:
        items = index.narrow(items, pattern)
    return items.filter(F.col("title").ilike(pattern))


def topk_recent(items: DataFrame, limit: int) -> DataFrame:
    """The newest rows; rows without a time come first, ties go by key. Every task keeps ``limit``."""
    return items.orderBy(F.desc_nulls_first("published_at"), F.asc("dedup_key")).limit(limit)


def intel_query(
    items: DataFrame, query: str | None = None, category: str | None = None,
    role_name: str | None = None, roles: DataFrame | None = None, limit: int = 5,
    role_filter: str = "before_limit", strict: bool = False, more: tuple[str, ...] = (), index: TitleIndex | None = None,
) -> DataFrame:
    """Newest items by keyword and category, six columns and ``more``; ``None`` and '' filter nothing.

    With ``role_filter='after_limit'`` the role is checked on the ``limit`` rows found, so fewer may
    come back.
    """
    found = title_ilike(items, query, index)
    if category:
        found = found.filter(F.col("category") == category)
    if role_name and role_filter == "before_limit":
        found = by_role(found, roles, role_name, strict)
    found = topk_recent(found, limit)
    if role_name and role_filter == "after_limit":
        found = by_role(found, roles, role_name, strict)
    return found.select(*QUERY_COLUMNS, *more)


def _unit_rows(vectors) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


class Nearest:
    """The k best documents of each query among those compared so far, ties by id; all rows are unit vectors.

    A comparison is made in single precision, with an allowance for its error (a sum of ``dim`` rounded products), against the k-th best that a
    query has; only what may reach that is computed in double precision, rounded and ranked. At most ``MAX_SIMILARITIES`` numbers are held at once.
    """

    def __init__(self, queries: np.ndarray, doc_ids: np.ndarray, docs: np.ndarray, k: int):
        self.queries, self.doc_ids, self.docs, self.k = queries, doc_ids, docs, k
        self.narrow_queries, self.narrow_docs = queries.astype(np.float32), docs.astype(np.float32)
        self.rank = np.empty(len(docs), dtype=np.int64)
        self.rank[np.argsort(doc_ids, kind="stable")] = np.arange(len(docs))
        self.slack = (queries.shape[1] + 16) * 2.0**-22
        self.sims, self.at = np.full((len(queries), k), -np.inf), np.full((len(queries), k), -1)

    def compare(self, asked: np.ndarray, start: int, stop: int) -> None:
        """Compares the queries at the places ``asked``, each once, with the documents from ``start`` to ``stop``."""
        step = MAX_SIMILARITIES // ROWS
        for first in range(0, len(asked), ROWS):
            some = asked[first:first + ROWS]
            for low in range(start, stop, step):
                about = self.narrow_queries[some] @ self.narrow_docs[low:min(stop, low + step)].T
                bar = self.sims[some, -1] - self.slack
                new = np.isneginf(bar)
                if new.any() and about.shape[1] > self.k:
                    bar[new] = np.partition(about[new], -self.k, axis=1)[:, -self.k] - 2 * self.slack
                rows, columns = np.nonzero(about >= bar.astype(np.float32)[:, None] - np.float32(1e-7))
                if len(rows):
                    self._take(some[rows], columns + low)

    def _take(self, rows: np.ndarray, at: np.ndarray) -> None:
        sims, step = np.empty(len(rows)), max(1, MAX_SIMILARITIES // max(1, self.docs.shape[1]))
        for i in range(0, len(rows), step):
            sims[i:i + step] = np.einsum("ij,ij->i", self.queries[rows[i:i + step]], self.docs[at[i:i + step]])
        sims = np.round(sims, SIMILARITY_DIGITS) + 0.0
        touched = np.unique(rows)
        known_rows, known = np.nonzero(self.at[touched] >= 0)
        known_rows = touched[known_rows]
        rows = np.concatenate([rows, known_rows])
        at, sims = np.concatenate([at, self.at[known_rows, known]]), np.concatenate([sims, self.sims[known_rows, known]])
        order = np.lexsort((self.rank[at], -sims, rows))
        rows, at, sims = rows[order], at[order], sims[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < self.k
        self.sims[rows[kept], place[kept]], self.at[rows[kept], place[kept]] = sims[kept], at[kept]

    def found(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the (similarities, ids), best first."""
        sizes = (self.at >= 0).sum(axis=1)
        return [(sims[:n], self.doc_ids[at[:n]]) for sims, at, n in zip(self.sims, self.at, sizes)]


def _k_best(queries: np.ndarray, doc_ids: np.ndarray, docs: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the (similarities, ids) of its k best documents, best first, ties by id."""
    finite = np.isfinite(docs).all(axis=1)
    nearest = Nearest(queries, doc_ids[finite], docs[finite], k)
    nearest.compare(np.arange(len(queries)), 0, int(finite.sum()))
    return nearest.found()


def _merged(best: list, found: list, k: int) -> list:
    out = []
    for (s1, d1), (s2, d2) in zip(best, found):
        sims, ids = np.concatenate([s1, s2]), np.concatenate([d1, d2])
        order = sorted(range(len(sims)), key=lambda i: (-sims[i], ids[i]))[:k]
        out.append((sims[order], ids[order]))
    return out


def _result(query_ids: list, best: list) -> pd.DataFrame:
    sizes = [len(sims) for sims, _ in best]
    return pd.DataFrame(
        {
            "query_id": np.repeat(np.asarray(query_ids, dtype=object), sizes),
            "doc_id": np.concatenate([ids for _, ids in best]),
            "similarity": np.concatenate([sims for sims, _ in best]),
        }
    )


def _nearest_per_task(documents: DataFrame, queries: DataFrame, k: int, schema: str) -> DataFrame:
    """Few queries: they go to every task, which keeps k documents per query while it reads on."""
    rows = queries.collect()
    query_ids, matrix = [r[0] for r in rows], _unit_rows([r[1] for r in rows])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            if batch.empty:
                continue
            found = _k_best(matrix, batch["doc_id"].to_numpy(dtype=object), _unit_rows(batch["vector"]), k)
            best = found if best is None else _merged(best, found, k)
        if best is not None:
            yield _result(query_ids, best)

    return documents.mapInPandas(scan, schema)


def _nearest_in_grid(
    documents: DataFrame, queries: DataFrame, k: int, schema: str, blocks: int, slices: int
) -> DataFrame:
    """Many queries: query blocks and document slices meet in a grid of cells, cut evenly by hashed ids.

    A cell holds at most about ``MAX_BROADCAST_VALUES`` numbers of queries (or ``max_values``, if that is more), eight times as many of documents
    and ``MAX_SIMILARITIES`` similarities (16, 128 and 16 MiB by default; vectors once more in single precision), and hands on k documents per query.
    """

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    right = documents.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int"))
    left, right = left.withColumn("slice", numbers(slices)), right.withColumn("block", numbers(blocks))

    def cell(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or stored.empty:
            return pd.DataFrame({"query_id": [], "doc_id": [], "similarity": []})
        ids = stored["doc_id"].to_numpy(dtype=object)
        best = _k_best(_unit_rows(asked["vector"]), ids, _unit_rows(stored["vector"]), k)
        return _result(list(asked["query_id"]), best)

    return (
        left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInPandas(cell, schema)
    )


def vector_topk(
    queries: DataFrame, documents: DataFrame, k: int = 3, max_values: int = MAX_BROADCAST_VALUES
) -> DataFrame:
    """The ``k`` documents with the highest cosine per query: ``(query_id, rank, doc_id, similarity)``.

    Exact. ``queries (query_id, vector)`` is measured first. While its vectors hold at most
    ``max_values`` numbers they are sent to every task and ``documents (doc_id, vector)`` is scanned
    once without a shuffle; beyond that, both sides meet in a grid of cells of bounded size. Pairs are
    never written out: a task or cell keeps k documents per query. Similarities are rounded to nine
    digits before ranking, ties go by ``doc_id``; a zero vector has similarity 0. The longest query vector sets the length;
    vectors of another length are neither asked for nor found. The query side is evaluated once.
    """
    queries = materialize(queries.select("query_id", "vector").filter(F.col("vector").isNotNull()))
    documents = documents.select("doc_id", "vector").filter(F.col("vector").isNotNull())
    n_queries, dim = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    id_types = [queries.schema["query_id"].dataType, documents.schema["doc_id"].dataType]
    schema = "query_id {}, doc_id {}, similarity double".format(*(t.simpleString() for t in id_types))
    queries, documents = (df.filter(F.size("vector") == dim) for df in (queries, documents))
    blocks = -(-n_queries * dim // max_values)
    # Small cells copy every document to many blocks: beyond a few blocks they grow, up to the default size.
    size = max(max_values, min(MAX_BROADCAST_VALUES, -(-n_queries * dim // FEW_BLOCKS)))
    if n_queries == 0:
        found = documents.sparkSession.createDataFrame([], schema)
    elif blocks == 1:
        found = _nearest_per_task(documents, queries, k, schema)
    else:
        slices = max(1, -(-documents.count() * dim // (8 * size)))
        found = _nearest_in_grid(documents, queries, k, schema, -(-n_queries * dim // size), slices)
    order = [F.col("similarity").desc(), F.col("doc_id").asc()]
    return first_per_group(found, ["query_id"], order, k, rank="rank").select(
        "query_id", "rank", "doc_id", "similarity"
    )

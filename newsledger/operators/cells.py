"""Exact nearest vectors, with cells of vectors skipped by the triangle inequality.

Centres are fitted on a bounded sample of the documents; every document is then placed at its nearest centre and, by its angle
to it, in a ring. A cell is one ring of one centre. Angles between unit vectors obey the triangle inequality, so a cell whose
documents lie between ``low`` and ``high`` from a centre holds nothing nearer to a query than ``max(low - a, a - high, 0)``,
``a`` being the query's angle to the centre. A query first searches the cells nearest to it until they hold k documents; with the
k-th similarity found there it then visits only cells that may hold a better or an equal one. Nothing is estimated: results equal a full comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsledger.operators.ranking import first_per_group
from newsledger.operators.search import MAX_BROADCAST_VALUES, Nearest, _result, _unit_rows
from newsledger.session import materialize

# Allowances for rounded angles and for similarities rounded to nine digits.
ANGLE_SLACK, SIMILARITY_SLACK = 1e-6, 1e-8
NO_CENTRE = -1  # of zero vectors


def _comparable(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))


def fit_centres(vectors: np.ndarray, count: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """At most ``count`` unit vectors that the directions of ``vectors`` gather around (spherical k-means)."""
    unit = np.unique(vectors[np.linalg.norm(vectors, axis=1) > 0], axis=0)
    if not len(unit):
        return np.zeros((0, vectors.shape[1]))
    centres = unit[np.random.default_rng(seed).permutation(len(unit))[:count]]
    for _ in range(rounds):
        nearest = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def _angles(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centres.T, -1.0, 1.0))


class _Bounds:
    """The best similarity that a query may find in each cell, and the order in which it visits cells."""

    def __init__(self, centres: np.ndarray, cells: list):
        self.centres = centres
        self.centre = np.array([c.centre for c in cells])
        self.size = np.array([c.n for c in cells])
        self.low = np.array([c.low for c in cells])
        self.high = np.array([c.high for c in cells])

    def best(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and cell: the upper bound of the similarity, and the angle to the cell's centre."""
        angle = np.zeros((len(unit), len(self.centre)))
        placed = self.centre != NO_CENTRE
        if placed.any():
            angle[:, placed] = _angles(unit, self.centres)[:, self.centre[placed]]
        gap = np.maximum(np.maximum(self.low - angle, angle - self.high) - ANGLE_SLACK, 0.0)
        bound = np.cos(gap)
        bound[:, ~placed] = 0.0
        bound[~unit.any(axis=1)] = 0.0
        return bound + SIMILARITY_SLACK, angle

    def first(self, unit: np.ndarray, k: int) -> list[np.ndarray]:
        """The cells nearest to each query that hold ``k`` documents together."""
        bound, angle = self.best(unit)
        off = np.abs(angle - (self.low + self.high) / 2)
        out = []
        for b, a, o in zip(bound, angle, off):
            order = np.lexsort((o, a, -b))
            out.append(order[: int(np.searchsorted(np.cumsum(self.size[order]), k)) + 1])
        return out

    def rest(self, unit: np.ndarray, k: int, least: np.ndarray) -> list[np.ndarray]:
        """The other cells that may hold a similarity of at least ``least``."""
        bound, _ = self.best(unit)
        return [np.setdiff1d(np.flatnonzero(b >= s), seen) for b, s, seen in zip(bound, least, self.first(unit, k))]


class VectorCells:
    """An index of ``documents (doc_id, vector)`` for exact searches.

    ``sample`` documents (those with the smallest hashed ids) are read to fit ``centres``; all documents are placed. Rings are ``ring``
    radians wide, so there are at most ``centres * (pi / ring + 1) + 1`` cells whatever the number of documents; only their sizes and borders go
    through the driver. Vectors that are null, hold null or non-finite components or are shorter than the longest are not found.
    A zero vector has similarity 0 with all.
    """

    def __init__(self, documents: DataFrame, centres: int = 64, sample: int = 4096, ring: float = 0.1, max_values: int = MAX_BROADCAST_VALUES):
        self.max_values = max_values
        documents = documents.select("doc_id", "vector").filter(_comparable("vector"))
        self.dim = documents.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
        documents = documents.filter(F.size("vector") == self.dim)
        some = documents.orderBy(F.xxhash64("doc_id"), "doc_id").limit(min(sample, max(1, max_values // max(1, self.dim)))).collect()
        self.centres = fitted = fit_centres(_unit_rows([r.vector for r in some]), centres) if some and self.dim else np.zeros((0, self.dim))

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if batch.empty:
                    continue
                unit = _unit_rows(batch["vector"])
                zero = ~unit.any(axis=1)
                angles = _angles(unit, fitted) if len(fitted) else np.zeros((len(unit), 1))
                nearest = np.where(zero, NO_CENTRE, np.argmin(angles, axis=1))
                angle = np.where(zero, 0.0, angles.min(axis=1))
                yield batch.assign(centre=nearest.astype("int32"), ring=np.floor(angle / ring).astype("int32"), angle=angle)

        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.schema.fields)
        self.placed = materialize(documents.mapInPandas(place, f"{types}, centre int, ring int, angle double"))
        sizes = self.placed.groupBy("centre", "ring").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
        self.cells = sizes.orderBy("centre", "ring").collect()
        self.slices, self.compared = self._slices(max(1, 8 * max_values // max(1, self.dim))), 0

    def _slices(self, most: int) -> list[tuple[int, int]]:
        """First slice and number of slices of each cell: neighbouring cells share a slice of at most ``most`` documents, a larger one is dealt into several."""
        out, current, room = [], -1, 0
        for cell in self.cells:
            parts = -(-cell.n // most)
            if parts > 1 or cell.n > room:
                out.append((current + 1, parts))
                current, room = current + parts, 0 if parts > 1 else most - cell.n
            else:
                out.append((current, 1))
                room -= cell.n
        return out

    def topk(self, queries: DataFrame, k: int = 3) -> DataFrame:
        """``(query_id, rank, doc_id, similarity)``: the rows of ``search.vector_topk``.

        Equal query vectors are asked once. Repeated rows of ``queries (query_id, vector)`` count once; an id with several vectors gets the
        answer of each; vectors that are not comparable or of another length get none. ``compared`` then tells how many pairs were compared.
        """
        spark, self.compared = queries.sparkSession, 0
        queries = queries.select("query_id", "vector").filter(_comparable("vector") & (F.size("vector") == self.dim))
        id_type = self.placed.schema["doc_id"].dataType.simpleString()
        schema = f"asked bigint, doc_id {id_type}, similarity double"
        asked = materialize(queries.select("vector").distinct().withColumn("asked", F.monotonically_increasing_id()))
        if not self.cells or asked.isEmpty():
            return spark.createDataFrame([], f"query_id {queries.schema['query_id'].dataType.simpleString()}, rank int, {schema.split(', ', 1)[1]}")
        bounds = _Bounds(self.centres, self.cells)

        slices = self.slices

        def routes(asked: np.ndarray, cells: list[np.ndarray]) -> pd.DataFrame:
            ways = []
            for some in cells:
                way = {}
                for c in some.tolist():
                    for s in range(slices[c][0], sum(slices[c])):
                        way.setdefault(s, []).append(c)
                ways.append([{"slice": s, "cells": here} for s, here in way.items()])
            return pd.DataFrame({"asked": asked, "ways": ways})

        def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not batch.empty:
                    yield routes(batch["asked"].to_numpy(), bounds.first(_unit_rows(batch["vector"]), k))

        def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not batch.empty:
                    least = batch["least"].to_numpy(dtype=float)
                    yield routes(batch["asked"].to_numpy(), bounds.rest(_unit_rows(batch["vector"]), k, least))

        order = [F.col("similarity").desc(), F.col("doc_id").asc()]
        routed = "asked bigint, ways array<struct<slice: int, cells: array<int>>>"
        near = self._search(asked, asked.mapInPandas(first, routed), k, schema)
        near = materialize(first_per_group(near, ["asked"], order, k))
        least = near.groupBy("asked").agg(F.min("similarity").alias("least"))
        more = asked.join(least, "asked").mapInPandas(rest, routed)
        found = near.unionByName(self._search(asked, more, k, schema))
        ranked = materialize(first_per_group(found, ["asked"], order, k, rank="rank"))
        members = queries.distinct().join(asked, "vector").select("query_id", "asked")
        return members.join(ranked, "asked").select("query_id", "rank", "doc_id", "similarity")

    def _search(self, asked: DataFrame, routes: DataFrame, k: int, schema: str) -> DataFrame:
        """The k best documents per query from each slice on its route, of the cells there that it needs.

        A query goes to a slice once, whichever of its cells it needs. A task holds about ``max_values`` numbers of queries and eight times as
        many of documents, however many lie in one cell.
        """
        routes = materialize(routes.select("asked", F.inline("ways")))
        counts = dict(routes.groupBy("slice").count().collect())
        spark = asked.sparkSession
        if not counts:
            return spark.createDataFrame([], schema)
        blocks = spark.createDataFrame([(s, -(-n * self.dim // self.max_values)) for s, n in counts.items()], "slice int, blocks int")
        dealt = spark.createDataFrame([(c.centre, c.ring, i, *self.slices[i]) for i, c in enumerate(self.cells)], "centre int, ring int, cell int, first int, parts int")

        left = routes.join(blocks, "slice").join(asked, "asked").withColumn("block", F.pmod(F.xxhash64("asked"), F.col("blocks")).cast("int"))
        right = self.placed.join(dealt, ["centre", "ring"]).withColumn("slice", F.col("first") + F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        right = right.join(blocks, "slice").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

        def compare(some: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
            if some.empty or stored.empty:
                return pd.DataFrame({"asked": [], "doc_id": [], "similarity": [], "compared": []})
            stored = stored.sort_values("cell", kind="stable")
            present, starts = np.unique(stored["cell"].to_numpy(), return_index=True)
            borders = np.append(starts, len(stored))
            docs, ids = _unit_rows(stored["vector"]), stored["doc_id"].to_numpy(dtype=object)
            unit, needs = _unit_rows(some["vector"]), some["cells"].to_list()
            # Cell by cell, all queries that need it at once; what a query has found so far narrows the next comparison.
            place, need = np.repeat(np.arange(len(needs)), [len(n) for n in needs]), np.concatenate(needs)
            nearest, pairs = Nearest(unit, ids, docs, k), np.zeros(len(unit), dtype=np.int64)
            for cell, start, stop in zip(present.tolist(), borders[:-1].tolist(), borders[1:].tolist()):
                rows = np.unique(place[need == cell])
                nearest.compare(rows, start, stop)
                pairs[rows] += stop - start
            best = nearest.found()
            compared = [n for (sims, _), total in zip(best, pairs.tolist()) if len(sims) for n in [total] + [0] * (len(sims) - 1)]
            return _result(list(some["asked"]), best).rename(columns={"query_id": "asked"}).assign(compared=compared)

        keys = ("slice", "block")
        left, right = left.select(*keys, "asked", "cells", "vector"), right.select(*keys, "cell", "doc_id", "vector")
        found = materialize(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, f"{schema}, compared bigint"))
        self.compared += found.agg(F.coalesce(F.sum("compared"), F.lit(0))).first()[0]
        return found.drop("compared")

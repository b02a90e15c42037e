"""Near-duplicate embeddings by lattice hashing.

Equal vectors of a label are one class. Each table projects the class vectors at random to eight dimensions and decodes
them to the nearest point of the E8 lattice; besides that cell, the nearest of the 240 neighbouring lattice points are probed. Vectors that share a
cell in any table meet, and their cosine is computed from the full vectors in double precision: links are found by probing and verified
exactly. With the default settings a pair at cosine 0.93 shares a cell in a table with probability 0.75, in none of ten with
about 1e-6; random vectors share one in 0.2 % of tables. Cells report a spanning set of their links, never all pairs; links are then counted
within each component in tiles of bounded size, copies by the size of their class.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows without a label, link with nothing;
vectors of different lengths never link; null and repeated ids keep all their rows, and copies of a row link with each other;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.components import components, smallest_linked, tiles, together, whole_groups
from newsledger.llm.shared import stored

TILE = 512


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points with integer coordinates of even sum."""
    rounded = np.rint(x)
    odd = np.flatnonzero(rounded.sum(1).astype(np.int64) & 1)
    gap = x[odd] - rounded[odd]
    worst = np.abs(gap).argmax(1)
    rounded[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
    return rounded


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: integer or half-integer coordinates of even sum."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = [
        [sign_i if k == i else sign_j if k == j else 0.0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2) for sign_i in (1.0, -1.0) for sign_j in (1.0, -1.0)
    ]
    halves = [signs for signs in itertools.product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(pairs + halves)


def cells(x: np.ndarray, probes: int) -> np.ndarray:
    """Codes of the nearest lattice point and of its ``probes`` neighbours nearest to x: one column each."""
    home, around = nearest_e8(x), neighbours()
    closeness = (x - home) @ around.T
    best = np.argpartition(-closeness, probes, axis=1)[:, :probes]
    points = np.concatenate([home[:, None, :], home[:, None, :] + around[best]], axis=1)
    return np.ascontiguousarray(np.rint(2 * points).astype(np.int8)).view(np.int64)[:, :, 0]


def projection(dimensions: int, table: int) -> np.ndarray:
    """Orthonormal directions onto eight dimensions, the same on every machine."""
    return np.linalg.qr(np.random.default_rng(1000 + table).normal(size=(max(dimensions, 8), 8)))[0][:dimensions]


def unit(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(lists), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows ** 2).sum(1, keepdims=True))


def _cells(tables: int, probes: int, scale: float):
    def run(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                rows = unit(part.column("embedding"))
                for table in range(tables):
                    codes = cells(rows @ projection(int(size), table) * (np.sqrt(size) / scale), probes)
                    at = np.repeat(np.arange(len(rows)), codes.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [part.column("class").take(pa.array(at)), part.column("label").take(pa.array(at)), part.column("size").take(pa.array(at)),
                         pa.array(np.full(len(at), table, np.int32)), pa.array(codes.ravel())],
                        ["class", "label", "size", "table", "cell"],
                    )

    return run


def _links(table: pa.Table, least: float):
    """Rows (by lag) of the same group whose cosine is at least ``least``."""
    group = table.column("group").to_numpy()
    label, sizes = table.column("label").to_numpy(), table.column("size").to_numpy()
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        rows = unit(table.column("embedding").combine_chunks().take(pa.array(own)))
        at = np.arange(len(own))
        for lag in range(1, len(own)):
            at = at[at + lag < len(own)]
            at = at[group[own[at]] == group[own[at + lag]]]
            if not len(at):
                break
            for k in range(0, len(at), 20_000):
                part = at[k:k + 20_000]
                cosine = np.einsum("ij,ij->i", rows[part], rows[part + lag])
                hit = part[(cosine >= least) & (label[own[part]] == label[own[part + lag]])]
                if len(hit):
                    yield own[hit], own[hit + lag]


def _spanning(least: float):
    def run(batches):
        for table in whole_groups(batches):
            found = list(_links(table, least))
            if found:
                label = smallest_linked(table.num_rows, np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
                at = np.flatnonzero(label != np.arange(len(label)))
                ids = table.column("class").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[label[at]])], ["a", "b"])

    return run


def _degrees(least: float):
    """Counts, in each tile, of a row's links to rows of other blocks, or of its own in a tile of one block."""

    def run(batches):
        for table in whole_groups(batches):
            block, weight = table.column("block").to_numpy(), table.column("copies").to_numpy().astype(np.float64)
            alone = table.column("tile_a").to_numpy() == table.column("tile_b").to_numpy()
            total = np.zeros(table.num_rows)
            for a, b in _links(table, least):
                here = alone[a] | (block[a] != block[b])
                total += np.bincount(a[here], weight[b[here]], table.num_rows) + np.bincount(b[here], weight[a[here]], table.num_rows)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([table.column("class").combine_chunks().take(pa.array(at)), pa.array(total[at].astype(np.int64))], ["class", "links"])

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93, tables: int = 10, probes: int = 4, scale: float = 1.2) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``, one row per row of ``vectors(vec_id, embedding, label)``."""
    value = F.col("embedding")
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    usable = F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))
    rows = stored(
        vectors.select("vec_id", "label", "embedding", usable.alias("usable")).select(
            "vec_id", F.when(F.col("usable"), F.xxhash64(F.lit(1), "label", "embedding")).alias("h1"),
            F.when(F.col("usable"), F.xxhash64(F.lit(2), "label", "embedding")).alias("h2"), "label", "embedding",
        ), "vectors",
    )
    classes = rows.filter("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()).withColumn("size", F.size("embedding")), "vector-classes")
    kind = classes.schema["label"].dataType.simpleString()
    in_cells = stored(
        classes.select("class", "label", "size", "embedding").mapInArrow(
            _cells(tables, probes, scale), f"class long, label {kind}, size int, table int, cell long"
        ), "cells",
    )
    keys = ["label", "size", "table", "cell"]
    met = tiles(in_cells, keys, "class", TILE, "cell-counts").join(classes.select("class", "embedding"), "class")
    found = stored(together(met, keys).select("group", "class", "label", "size", "embedding").mapInArrow(_spanning(least), "a long, b long"), "vector-links")
    joined = components(found)
    members = joined.join(classes.withColumnRenamed("class", "node"), "node").withColumnRenamed("node", "class")
    crowd = together(tiles(members.select("component", "class", "label", "size", "copies", "embedding"), ["component"], "class", TILE, "component-sizes"), ["component"])
    degrees = (
        crowd.select("group", "class", "label", "size", "copies", "embedding", "block", "tile_a", "tile_b")
        .mapInArrow(_degrees(least), "class long, links long").groupBy("class").agg(F.sum("links").alias("links"))
    )
    first = members.groupBy("component").agg(F.min("first_id").alias("component_first"))
    of_class = (
        members.select("class", "component").join(first, "component").join(degrees, "class", "left").select("class", "component_first", "links")
    )
    known = classes.select("h1", "h2", "class", "first_id", "copies").join(of_class, "class", "left").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_first", "first_id").alias("component_id")
    )
    out = rows.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op1_lattice", """
    WITH RECURSIVE
    vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL),
    fine AS (SELECT * FROM vectors WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: abs(x))) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reach AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT b, root FROM reach JOIN links ON a = vec_id),
    degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT r.vec_id, coalesce(n, 0) AS n_links, min(root) AS component_id, r.vec_id = min(root) AS kept
    FROM reach r LEFT JOIN degrees ON a = r.vec_id GROUP BY r.vec_id, n
""")
def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

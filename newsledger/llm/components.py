"""Connected components of links, and groups split into tiles of bounded size, both for any number of rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger.llm.shared import stored


LINKS = 20_000


def _least(pairs: DataFrame, tasks: int, name: str) -> DataFrame:
    """Each node with the smallest of itself and its neighbours; a table of its own, so that joins with it may be split."""
    return stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks), name)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for all nodes of ``links(a, b)``.

    Large-star and small-star steps in turn until nothing changes: each hangs neighbours on the smallest one, so a step
    moves each link once and long chains shorten geometrically. Every round is a table in the shared folder, written by as
    many tasks as its links need: the session's shuffle partitions are meant for other tables than what is left of links.
    """
    links = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        found = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (found.n, found.x) == state or not found.n:
            break
        state, tasks = (found.n, found.x), math.ceil(found.n / LINKS)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both, tasks, "large-star"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct().coalesce(tasks), "large-links")
        small = large.join(_least(large, tasks, "small-star"), "u")
        pairs = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p"))
        links = stored(pairs.select("p.u", "p.v").filter("u <> v").distinct().coalesce(tasks), "small-links")
    stars = links.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    nodes = stars.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    return stored(nodes.coalesce(max(math.ceil(found.n / LINKS), 1)), "components")


def tiles(rows: DataFrame, keys: list[str], node: str, size: int, name: str) -> DataFrame:
    """Groups of more than one row, cut so that every two rows of a group meet in exactly one or, within a block, in several tiles.

    Adds ``block``, ``tile_a``, ``tile_b``: a group of up to ``size`` rows is one tile (0, 0); a larger one is dealt into blocks
    by hash, and tile (a, b) holds blocks a and b. Two rows of different blocks meet in one tile, rows of one block also in tile (a, a).
    """
    counts = stored(rows.groupBy(*keys).agg(F.count("*").alias("_rows")).filter("_rows > 1"), name)
    blocks = F.ceil(F.col("_rows") / size).cast("int")
    found = rows.join(counts, keys).withColumn("_blocks", blocks).withColumn("block", F.pmod(F.xxhash64(node), F.col("_blocks")).cast("int"))
    found = found.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return found.withColumn("tile_a", F.least("block", "_other")).withColumn("tile_b", F.greatest("block", "_other")).drop("_rows", "_blocks", "_other")


def together(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a tile in one task, one after the other; ``group`` numbers them."""
    tile = [*keys, "tile_a", "tile_b"]
    return rows.withColumn("group", F.xxhash64(*tile)).repartition(*tile).sortWithinPartitions("group", *tile)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups (equal neighbouring values of ``group``), however batches cut them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None and rest.num_rows else table
        group = table.column("group").to_numpy()
        start = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else 0
        if start:
            yield table.slice(0, start).combine_chunks()
        rest = table.slice(start)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def smallest_linked(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 .. count - 1 and links a - b: the smallest node that each is linked with, over any number of links."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new

"""The prefix trie of conversations, built by halving: cut all sequences at half their depth, and each half again.

A turn's name is a hash of its role and text; texts themselves are never shuffled. Going up, names of two neighbouring blocks of turns give the
name of the block of twice the width. Going down, every sequence is cut at half depth: the prefix up to the cut is named by the prefix up to
the coarser cut before it and the block in between, which leaves an upper trie and a forest below the cuts, both of half the depth and named in
the same rounds. After as many rounds as the longest sequence has binary digits each prefix, that is each node, has its
name (SHA-256, so equal names are equal prefixes), with work in proportion to the turns.

Totals are grafted upward through the same cuts. A node's own figures stand at the path of its smallest member; what lies below a cut
is added to the blocks above it, so each place on a path gets the sum from there to the end, and a node's subtree is the sum over
its members' paths at its depth.

No group is brought into one task: turns are numbered by their place in a global sort, conversations meet their own figures in joins
that may be split, nodes are aggregates with map-side combining. Only the checksum of a node's member ids, which nothing can
compute in parts, streams through one task, over runs of ids that were joined in parallel.

Cases: null role or text counts as empty; turns go by number (null first), those of equal number by the hash of role and text; repeated rows are
turns of their own; rows without conversation id belong to no conversation and are left out; an empty table gives no rows; further
columns are ignored. A conversation of any length is spread over tasks.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.shared import stored

RUN = 4096
EMPTY = hashlib.sha256(b"").hexdigest()


def _name(*parts: Column | str) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 0), ``turn_name``, ``turn_bytes``, and ``n_turns`` of the conversation, one row per turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _name(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("turn_name"),
        F.octet_length(text).cast("long").alias("turn_bytes"), F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv_id", "turn", "turn_name", "tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    table = stored(dealt.select("conv_id", "turn_name", "turn_bytes", F.shiftright("at", 33).cast("int").alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("row")), "turns")
    counts = table.groupBy("part").agg(F.count("*").alias("rows"))  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    placed = stored(table.join(F.broadcast(starts), "part").select("conv_id", (F.col("before") + F.col("row")).alias("place"), "turn_name", "turn_bytes"), "places")
    firsts = stored(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("n_turns")), "conversations")
    return placed.join(firsts, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("pos"), "turn_name", "turn_bytes", "n_turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversation ids, and the rebuilt turns: ``conv_id``, ``depth`` (from 1), ``name``, ``bytes``.

    A conversation takes the first ``h`` turns of its base (``conv_id - conv_id % 5``), then its own after its first ``h``; ``h`` is the id's
    crc32 modulo 9, so a base gives away at most eight turns to at most nine conversations.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % 9
    base = F.col("conv_id") - F.col("conv_id") % 5
    turns = stored(turns, "numbered-turns")
    sizes = stored(turns.filter("pos = 0").select("conv_id", "n_turns"), "sizes")
    lent = sizes.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    convs = sizes.select("conv_id", h.alias("h"), base.alias("base")).join(lent, "base", "left")
    convs = stored(convs.select("conv_id", "h", "base", F.least("h", F.coalesce("base_turns", F.lit(0))).alias("taken")), "rebuilt-conversations")
    heads = turns.filter("pos < 8").select(F.col("conv_id").alias("base"), "pos", "turn_name", "turn_bytes")
    first = convs.filter("taken > 0").join(heads, "base").filter("pos < h")
    first = first.select("conv_id", (F.col("pos") + 1).alias("depth"), "turn_name", "turn_bytes")
    own = turns.filter(F.col("pos") >= h).join(convs.select("conv_id", "h", "taken"), "conv_id")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "turn_name", "turn_bytes")
    columns = ["conv_id", "depth", F.col("turn_name").alias("name"), F.col("turn_bytes").alias("bytes")]
    return convs.select("conv_id"), stored(first.unionByName(own).select(*columns), "rebuilt-turns")


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth`` (from 0), ``node`` (the name of the prefix) for every place on every path."""
    longest = turns.agg(F.max("depth")).first()[0] or 0
    # Upward: block i of level k holds the turns after depth i * 2^k up to depth (i + 1) * 2^k.
    levels = [turns.select("conv_id", (F.col("depth") - 1).alias("i"), "name")]
    while 2 << (len(levels) - 1) <= longest:
        half = levels[-1].withColumn("pair", F.floor(F.col("i") / 2))
        left, right = (half.filter(F.col("i") % 2 == side).select("conv_id", "pair", F.col("name").alias(c)) for side, c in enumerate(("left", "right")))
        whole = left.join(right, ["conv_id", "pair"]).select("conv_id", F.col("pair").alias("i"), _name("left", "right").alias("name"))
        levels.append(stored(whole, "blocks"))
    # Downward: cuts in the middle between the cuts that have names.
    known = stored(convs.select("conv_id", F.lit(0).cast("long").alias("depth"), _name(F.lit("root")).alias("node")), "roots")
    for k in range(len(levels) - 1, -1, -1):
        if longest:
            below = levels[k].filter("i % 2 = 0").select("conv_id", (F.col("i") * (1 << k)).alias("depth"), "name")
            cut = known.join(below, ["conv_id", "depth"])
            named = cut.select("conv_id", (F.col("depth") + (1 << k)).alias("depth"), _name("node", "name").alias("node"))
            known = known.unionByName(stored(named, "cuts"))
    return known


def grafted(weights: DataFrame, sums: list[str]) -> DataFrame:
    """For each ``conv_id``, ``depth``: the sums of the weights from there to the end of the path, added up through the cuts."""
    longest = weights.agg(F.max("depth")).first()[0] or 0
    levels = [weights.select("conv_id", F.col("depth").alias("i"), *sums)]
    while 1 << len(levels) <= longest:
        wider = levels[-1].groupBy("conv_id", F.floor(F.col("i") / 2).alias("i")).agg(*(F.sum(c).alias(c) for c in sums))
        levels.append(stored(wider, "block-sums"))
    whole = levels[-1].groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in sums))
    known = stored(whole.select("conv_id", F.lit(0).cast("long").alias("depth"), *sums), "whole-sums")
    for k in range(len(levels) - 1, -1, -1):
        above = levels[k].filter("i % 2 = 1").select("conv_id", (F.col("i") * (1 << k)).alias("depth"), *sums)
        below = known.select("conv_id", (F.col("depth") - (1 << k)).alias("depth"), *(F.col(c).alias(f"below_{c}") for c in sums))
        cut = above.join(below, ["conv_id", "depth"], "left")
        known = known.unionByName(stored(cut.select("conv_id", "depth", *((F.col(c) + F.coalesce(f"below_{c}", F.lit(0))).alias(c) for c in sums)), "grafts"))
    return known


def _runs(batches):
    """Sorted rows ``(node, conv_id)`` to runs of at most ``RUN`` ids of one node, joined by commas."""
    for batch in batches:
        nodes, ids = (batch.column(c).to_pylist() for c in ("node", "conv_id"))
        out, start = [], 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or nodes[i] != nodes[start] or i - start == RUN:
                out.append((nodes[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        columns = list(zip(*out)) or [(), (), ()]
        kinds = (pa.binary(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "first", "ids"])


def _checksums(batches):
    """Sorted runs to one checksum per node; holds one run and one state at a time."""
    node = state = None
    for batch in batches:
        nodes, ids = (batch.column(c).to_pylist() for c in ("node", "ids"))
        out = []
        for name, run in zip(nodes, ids):
            if name != node:
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(run.encode())
            else:
                state.update(b"," + run.encode())
        columns = list(zip(*out)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["node", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["node", "ends_sha256"])


def end_checksums(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256`` of ``ends(node, conv_id)``."""
    dealt = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    runs = dealt.select("node", "conv_id").mapInArrow(_runs, "node binary, first long, ids string")
    return runs.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_checksums, "node binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, with the figures of its subtree."""
    convs, turns = rebuilt(turns_of(conversations))
    paths = stored(prefixes(convs, turns), "paths")
    lengths = stored(paths.groupBy("conv_id").agg(F.max("depth").alias("length")), "lengths")
    nodes = stored(paths.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs")), "nodes")

    # A node's figures stand at its smallest member; the path of a conversation ends in the nodes that it is the smallest member of.
    place = ["conv_id", "depth"]
    placed = nodes.join(turns.select(*place, "bytes"), place, "left").withColumn("saved_tokens", (F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0)))
    above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    placed = placed.join(above, place, "left").join(lengths, "conv_id")
    placed = stored(placed.select("node", *place, "parent", "n_convs", "saved_tokens", (F.col("depth") < F.col("length")).cast("long").alias("follows")), "placed-nodes")
    tops = placed.groupBy("conv_id").agg(F.min("depth").alias("depth")).filter("depth > 0")
    branches = stored(placed.join(tops, place, "left_semi").select(*place, "parent"), "branches")
    branched = branches.groupBy("parent").agg(F.count("*").alias("n_branches"))
    over = branches.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent").select(*place, "parent_conv_id")
    figures = placed.join(branched.withColumnRenamed("parent", "node"), "node", "left").join(over, place, "left")
    figures = figures.withColumn("n_children", F.col("follows") + F.coalesce("n_branches", F.lit(0)))
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    figures = stored(figures.select("node", *place, parent.alias("parent_conv_id"), "n_convs", "n_children", "saved_tokens"), "figures")

    sums = ["n_leaves", "saved_tokens"]
    own = figures.select(*place, (F.col("n_children") == 0).cast("long").alias("n_leaves"), "saved_tokens")
    weights = paths.select(*place).join(own, place, "left").select(*place, *(F.coalesce(c, F.lit(0)).alias(c) for c in sums))
    below = grafted(stored(weights, "weights"), sums)
    totals = paths.join(below, place).groupBy("node").agg(*(F.sum(c).alias(c) for c in sums))
    ends = end_checksums(paths.join(lengths.withColumnRenamed("length", "depth"), place).select("node", "conv_id"))
    return figures.drop("saved_tokens").join(totals, "node").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")
    )


@query("op13_prefix_trie", """
    WITH RECURSIVE
    crc_table AS (SELECT list(v ORDER BY b) AS entries FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
        lambda a, i: CASE WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(b))),
    ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
    hashed AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, x: xor(a >> 8, entries[(xor(a, x) & 255) + 1])), 4294967295) % 9 AS h FROM ids, crc_table),
    named AS (SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
        sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS name FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT conv_id, name, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) - 1 AS pos FROM named),
    pieces AS (SELECT h.conv_id, 0 AS part, pos, name, bytes FROM hashed h JOIN placed p ON p.conv_id = h.base AND pos < h
        UNION ALL SELECT h.conv_id, 1, pos, name, bytes FROM hashed h JOIN placed p ON p.conv_id = h.conv_id AND pos >= h),
    turns AS (SELECT conv_id, name, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM pieces),
    paths AS (SELECT conv_id, 0 AS depth, '' AS node, 0 AS bytes FROM ids
        UNION ALL SELECT p.conv_id, t.depth, sha256(p.node || t.name), t.bytes FROM paths p JOIN turns t ON t.conv_id = p.conv_id AND t.depth = p.depth + 1),
    nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved FROM paths GROUP BY node, depth),
    parents AS (SELECT n.node, n.conv_id, n.depth, n.n_convs, n.saved, p.node AS parent FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
    children AS (SELECT parent AS node, count(*) AS n_children FROM parents WHERE parent IS NOT NULL GROUP BY parent),
    figures AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN children USING (node)),
    totals AS (SELECT a.node, sum((f.n_children = 0)::INT) AS n_leaves, sum(f.saved) AS saved_tokens
        FROM figures f JOIN paths a ON a.conv_id = f.conv_id AND a.depth <= f.depth GROUP BY a.node),
    ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS members
        FROM (SELECT * FROM paths QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY node)
    SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, t.n_leaves::BIGINT AS n_leaves,
        t.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(members, '')) AS ends_sha256
    FROM figures f JOIN totals t USING (node) LEFT JOIN nodes p ON p.node = f.parent LEFT JOIN ends e ON e.node = f.node
""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

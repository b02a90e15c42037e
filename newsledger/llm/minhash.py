"""Near-duplicate documents by bottom-k sketches.

A document's shingles (five words in a row) are hashed once; its sketch is the ``k`` smallest values. Documents with the same words
are one class. Sketch values held by several classes form inverted lists. Two sets with similarity ``least`` share so many sketch
values (``needed``; fewer has a probability of about 1e-7, none for sets within a sketch) that they share one of each sketch's rarest values already: only those
lists are used, so passages that many documents share generate nothing unless they make up most of a sketch.

Links are found in two rounds. First each document of a list is compared with the list's smallest class of about its size,
by the sketch of their union and then on the full sets, which joins most groups by as many comparisons as they have
members. Documents connected by lists form families; a family that is still several components is compared in tiles of bounded size, on the full sets of
its documents: counts of common shingles come from one matrix product over distinct columns. Families of one component need no further
comparison, as the result is components; no pair between components is left out. Tiles report a spanning set of their links.

Cases: null or blank text has no set and links with nothing; texts under five words are one shingle; repeated ids keep
all their rows (rows of one id and different texts are different nodes); null ids come last; an empty table gives no rows; further columns are ignored by ``find``
and kept by ``dedup``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.components import components, smallest_linked, tiles, together, whole_groups
from newsledger.llm.ppm import normal
from newsledger.llm.quality import MULTIPLIER, SPACES, word_hashes
from newsledger.llm.shared import documents, release_worker, stored, texts_of
from newsledger.llm.token_files import slices

K = 48
WORDS = 5
TILE = 512
PARTNERS = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(raws: list[bytes]) -> list[np.ndarray]:
    """The distinct shingle hashes of each normalised text, sorted."""
    raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    edges = np.diff(np.concatenate([[True], SPACES[raw]]).astype(np.int8))
    starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    words = mixed(word_hashes(raw, starts, stops))
    borders = np.concatenate([[0], np.searchsorted(starts, ends)])
    sums = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        sums = mixed(sums * MULTIPLIER + words[k:len(words) - WORDS + 1 + k]) if len(sums) else sums
    out = []
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(sums[a:b - WORDS + 1].view(np.int64)))
        else:
            short = np.array([b - a], np.uint64)
            for word in words[a:b]:
                short = mixed(short * MULTIPLIER + word)
            out.append(short.view(np.int64) if b > a else np.zeros(0, np.int64))
    return out


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that stand for a row's id and whole text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))


def _sketch(k: int):
    def run(batches):
        release_worker()
        for batch, texts in slices(batches):
            raws = [normal(t) for t in texts]
            sets = shingle_sets(raws)
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            names = [np.frombuffer(hashlib.blake2b(b" ".join(r.split()), digest_size=16).digest(), "<i8") if n else (None, None) for r, n in zip(raws, sizes)]
            kept = [s[:k] for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept])])
            sketches = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(kept)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(sizes), pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()), sketches],
                ["doc_id", "key", "n", "h1", "h2", "sketch"],
            )

    return run


def needed(n: Column, k: int, least: float) -> Column:
    """How many sketch values a set of ``n`` shingles shares at least with any similar one."""
    expected = k * least
    random = math.floor(expected - 5.7 * math.sqrt(k * least * (1 - least)))
    return F.when(n <= math.floor(k * least), F.ceil(n * least)).otherwise(F.lit(random)).cast("int")


def similar_sketches(a: Column, b: Column, k: int, least: float) -> Column:
    """Whether the sketch of the union allows the similarity; exact if the union is no larger than a sketch."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), union))
    random = math.floor(k * least - 5.7 * math.sqrt(k * least * (1 - least)))
    return F.when(F.size(union) < k, shared >= least * F.size(union)).otherwise(shared >= random)


def _verify(batches):
    """Streams hubs, each followed by its partners, and counts common and all shingles of each pair."""
    hub, own = None, None
    for batch, texts in slices(batches):
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("a", "part", "b"))))
        sets = shingle_sets([normal(t) for t in texts])
        found = []
        for (a, part, b), values in zip(rows, sets):
            if b is None:
                hub, own = (a, part), values
            elif hub == (a, part):
                common = len(np.intersect1d(own, values, assume_unique=True))
                found.append((a, b, common, len(own) + len(values) - common))
        columns = list(zip(*found)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "common", "total"])


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are similar enough; ``texts(class, text)`` has their texts.

    Partners of one hub are dealt to tasks by ``PARTNERS``; a task holds one hub's set at a time.
    """
    counts = stored(pairs.groupBy("a").agg(F.count("*").alias("partners")), "partner-counts")
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / PARTNERS)).cast("int")
    dealt = stored(pairs.join(counts, "a").select("a", part.alias("part"), "b"), "dealt-pairs")
    partners = dealt.join(texts.withColumnRenamed("class", "b"), "b").select("a", "part", "b", "text")
    hubs = dealt.select("a", "part").distinct().join(texts.withColumnRenamed("class", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    rows = hubs.unionByName(partners).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    checked = rows.mapInArrow(_verify, "a long, b long, common long, total long")
    percent = round(100 * least)
    return stored(checked.filter(f"100 * common >= {percent} * total"), "similar-pairs")


def common_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share.

    Shingles held by the same sets are one column that counts as often; those held by one set are no column at all.
    """
    count = len(sets)
    if not count:
        return np.zeros((0, 0))
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(count), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    heads = np.flatnonzero(np.diff(flat, prepend=~flat[:1])) if len(flat) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(flat)))
    shared = np.flatnonzero(sizes > 1)
    if not len(shared):
        return np.zeros((count, count))
    codes = np.random.default_rng(11).integers(1, 1 << 63, count, dtype=np.uint64)
    holders = np.add.reduceat(codes[row], heads)[shared]
    _, first, times = np.unique(holders, return_index=True, return_counts=True)
    common = np.zeros((count, count))
    for k in range(0, len(first), 8192):
        part = shared[first[k:k + 8192]]
        n = sizes[part]
        at = np.repeat(heads[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        held = np.zeros((count, len(part)), np.float32)
        held[row[at], np.repeat(np.arange(len(part)), n)] = 1
        common += (held * times[k:k + 8192].astype(np.float32)) @ held.T
    return common


def _linked_in_tile(percent: int):
    def run(batches):
        for table in whole_groups(batches):
            group, ids = table.column("group").to_numpy(), table.column("class").to_numpy()
            borders = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
            left, right = [], []
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                sets = shingle_sets([normal(t) for t in table.column("text").slice(a, b - a).to_pylist()])
                common, n = common_shingles(sets), np.array([len(s) for s in sets])
                i, j = np.nonzero(np.triu(100 * common >= percent * (n[:, None] + n[None, :] - common), 1))
                label = smallest_linked(b - a, i, j)
                at = np.flatnonzero(label != np.arange(b - a))
                left.append(ids[a + at])
                right.append(ids[a + label[at]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    return run


def link(docs: DataFrame, k: int = K, least: float = 0.75) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their set size and class, the classes, and the components of the classes that have links."""
    source = texts_of(docs).select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    rows = stored(source.mapInArrow(_sketch(k), "doc_id long, key string, n long, h1 long, h2 long, sketch array<long>"), "sketches")
    classes = rows.filter("n > 0").groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "key")).alias("row"), F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "word-classes")
    postings = classes.select("class", "n", F.explode("sketch").alias("value"))
    lists = stored(postings.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"), "shared-values")
    shared = postings.join(lists, "value").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
    alone = F.least("n", F.lit(k)) - F.size("values")
    rarest = F.least("n", F.lit(k)) - needed(F.col("n"), k, least) + 1 - alone
    used = stored(
        shared.withColumn("used", rarest.cast("int")).filter("used > 0").select("class", "n", F.slice("values", F.lit(1), F.least("used", F.size("values"))).alias("values")),
        "prefixes",
    )
    entries = used.select("class", "n", F.explode("values.value").alias("value"))
    sketches = used.select("class").join(classes, "class").select("class", "sketch", "row.doc_id", "row.key")
    sketches = stored(sketches, "used-sketches")
    wanted = sketches.select("class", F.col("doc_id").alias("_id"), F.col("key").alias("_newsledger_key"))
    texts = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_newsledger_key"))).select("class", "text")
    texts = stored(texts.dropDuplicates(["class"]), "used-texts")

    # Round one: the smallest class of each list among those of about the same size.
    sized = entries.withColumn("about", F.floor(F.log(F.col("n").cast("double")) / math.log(1 / least)).cast("int"))
    heads = stored(sized.groupBy("value", "about").agg(F.min("class").alias("head")), "list-heads")
    stars = sized.join(heads, ["value", "about"]).filter("class <> head").select(F.col("head").alias("a"), F.col("class").alias("b")).distinct()
    left, right = (sketches.select(F.col("class").alias(c), F.col("sketch").alias(f"sketch_{c}")) for c in ("a", "b"))
    stars = stars.join(left, "a").join(right, "b").filter(similar_sketches(F.col("sketch_a"), F.col("sketch_b"), k, least)).select("a", "b")
    found = verified(stored(stars, "star-pairs"), texts, least)
    joined = components(found.select("a", "b"))

    # Round two: families of several components. Lists join components, so those of one component are no nodes here.
    root = F.coalesce("component", "class").alias("root")
    rooted = stored(used.join(joined.withColumnRenamed("node", "class"), "class", "left").select("class", root, "values.value"), "rooted")
    met = rooted.select("root", F.explode("value").alias("value"))
    smallest = stored(met.groupBy("value").agg(F.min("root").alias("head")), "value-heads")
    families = components(met.join(smallest, "value").select(F.col("head").alias("a"), F.col("root").alias("b")))
    members = rooted.select("class", F.col("root").alias("node")).join(families.withColumnRenamed("component", "family"), "node")
    crowd = tiles(stored(members.select("family", "class"), "families"), ["family"], "class", TILE, "family-sizes").join(texts, "class")
    tiled = together(crowd, ["family"]).select("group", "class", "text")
    more = stored(tiled.mapInArrow(_linked_in_tile(round(100 * least)), "a long, b long"), "tile-links")
    if not more.isEmpty():
        joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    return rows, classes, joined


def _grouped(docs: DataFrame, k: int, least: float) -> DataFrame:
    """``doc_id``, ``key``, ``n_shingles``, ``component`` (of classes, null without a set) and ``component_id``, one row per row of ``docs``."""
    rows, classes, joined = link(docs, k, least)
    first = classes.select("class", "first_id", "h1", "h2").join(joined.withColumnRenamed("node", "class"), "class", "left")
    first = stored(first.withColumn("component", F.coalesce("component", F.col("class"))), "class-components")
    smallest = stored(first.groupBy("component").agg(F.min("first_id").alias("component_id")), "component-ids")
    of_class = stored(first.join(smallest, "component").select("h1", "h2", "component", "component_id"), "class-ids")
    return rows.select("doc_id", "key", F.col("n").alias("n_shingles"), "h1", "h2").join(of_class, ["h1", "h2"], "left").select(
        "doc_id", "key", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def find(docs: DataFrame, k: int = K, least: float = 0.75) -> DataFrame:
    """``doc_id``, ``key``, ``n_shingles``, ``component_id``, ``kept``, one row per row of ``docs``."""
    return _grouped(docs, k, least).drop("component").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup(docs: DataFrame, k: int = K, least: float = 0.75) -> DataFrame:
    """One document of each component, with all columns of ``docs``: that with the smallest id (null last), then key."""
    rows = _grouped(docs, k, least).select("component", "doc_id", "key")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("row")
    chosen = rows.filter("component IS NOT NULL").groupBy("component").agg(smallest).select("row.key")
    kept = stored(chosen.unionByName(rows.filter("component IS NULL").select("key")).select(F.col("key").alias("_newsledger_key")), "kept-keys")
    return docs.withColumn("_newsledger_key", row_key(F.col("doc_id"), F.col("text"))).join(kept, "_newsledger_key", "left_semi").dropDuplicates(["_newsledger_key"]).drop("_newsledger_key")


@query("op10_minhash", """
    WITH RECURSIVE
    words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    sets AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
    reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT b, root FROM reach JOIN links ON a = doc_id)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id, d.doc_id = min(root) AS kept
    FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, n
""")
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir)).drop("key")

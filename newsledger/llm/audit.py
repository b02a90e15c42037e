"""How filters interact: for every order in which they may run, what each step keeps, removes and costs.

Each document is judged by all filters at once. Spark counts documents by part and by the set of filters that they fail, so
what is left per part is a contingency tensor with one axis of two (pass, fail) per filter: 2x2x2x2x2 counts for five
filters, whatever the number of documents. All steps of all orders are then contractions of that tensor: a selector per
axis takes pass, fail or all, and one einsum gives the counts of every step.

Copies are judged without bringing the copies of a text together: the smallest id of each text is an aggregate with map-side
combining, and a row fails if it does not meet that aggregate by text and id.

Cases: null text counts as empty, null part as the empty string; a null id has no smaller one and no labels; repeated rows
count as often as they occur, and those with the smallest id of their text are no copies; labels of one id are combined
(1 if any row says 1), other values than 1 and missing labels are no label; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.shared import documents, labels, stored

LETTERS = "ABCDE"
SPACE = "[\\x20\\x09-\\x0D]+"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
SALTS = 1024
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> list[Column]:
    """The failure conditions A to D, which look at one text alone."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``fails`` (bit i: the i-th filter) and ``rows``, how many rows are alike in all of these and the text."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((c.cast("int") * (1 << i) for i, c in enumerate(text_failures(text))), F.lit(0))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("text_key"), bits.alias("bits"),
    )
    rows = stored(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("rows")), "audit-rows")
    firsts = rows.filter("doc_id IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    firsts = stored(firsts.withColumn("first", F.lit(True)), "first-ids")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(firsts, ["text_key", "doc_id"], "left").select(
        "doc_id", "part", (F.col("bits") + F.when(copy, 1 << LETTERS.index("E")).otherwise(0)).alias("fails"), "rows"
    )


def tally(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of rows, good and toxic ones by ``part`` and ``fails``: at most 2 to the number of filters per part."""
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = stored(known.withColumn("salt", F.lit(0)), "audit-labels")
    # Rows without id find no labels; dealt by a salt, they do not meet in one task either.
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("int")
    with_labels = rows.withColumn("salt", salt).join(known, ["doc_id", "salt"], "left")
    return with_labels.groupBy("part", "fails").agg(
        F.sum("rows").alias("n"), *(F.sum(F.col("rows") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic"))
    )


def contracted(tensors: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """For each row of ``selectors`` (axis, pass/fail) the selected sum of each of the ``tensors``."""
    axes = "abcdefgh"[:tensors.ndim - 1]
    subscripts = f"m{axes},{','.join('s' + a for a in axes)}->sm"
    return np.einsum(subscripts, tensors, *(selectors[:, k] for k in range(len(axes))), optimize=True)


def plan(letters: str = LETTERS) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
    """All orders, the filter of each step of each, and the selectors of each step by measure."""
    orders = list(permutations(range(len(letters))))
    at = np.array(orders).ravel()
    shape = (len(at), len(letters), 2)
    kept, removed, failing, alone = (np.empty(shape, np.int64) for _ in range(4))
    kept[:], removed[:], failing[:], alone[:] = ALL, ALL, ALL, PASS
    for row, f in enumerate(at):
        order, step = orders[row // len(letters)], row % len(letters)
        removed[row, list(order[:step])] = PASS
        kept[row, list(order[:step + 1])] = PASS
        for selector in (removed, failing, alone):
            selector[row, f] = FAIL
    names = ["".join(letters[i] for i in order) for order in orders]
    return names, at, {"kept": kept, "removed": removed, "failing": failing, "alone": alone}


def contractions(letters: str = LETTERS):
    """A function from the cells of one part to its rows, one per order and step."""
    names, at, selectors = plan(letters)
    n = len(letters)

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        flat = np.zeros((3, 1 << n), np.int64)
        flat[:, cells["fails"].to_numpy()] = cells[["n", "good", "toxic"]].to_numpy(np.int64).T
        tensors = flat.reshape((3,) + (2,) * n).transpose(0, *range(n, 0, -1))  # axis i + 1: bit i
        found = {name: contracted(tensors, s) for name, s in selectors.items()}
        removed = found["removed"]
        shares = np.zeros(n, np.int64)
        np.add.at(shares, at, removed[:, 0])
        return pd.DataFrame({
            "part": cells["part"].iloc[0], "filter_order": np.repeat(names, n), "step": np.tile(np.arange(1, n + 1, dtype=np.int32), factorial(n)),
            "kept": found["kept"][:, 0], "removed": removed[:, 0], "redundant": found["failing"][:, 0] - removed[:, 0],
            "unique_fails": found["alone"][:, 0], "good_lost": removed[:, 1], "toxic_lost": removed[:, 2], "shapley": shares[at],
        })

    return run


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    return tally(judged(docs), labels).groupBy("part").applyInPandas(contractions(), SCHEMA)


@query("op11_filter_audit", """
    WITH base AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    split AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM base),
    known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    flags AS (SELECT doc_id, part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS fails FROM split),
    cells AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
        FROM flags LEFT JOIN known USING (doc_id) GROUP BY part, fails),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
    orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
        FROM letters v, letters w, letters x, letters y, letters z WHERE v.b + w.b + x.b + y.b + z.b = 31
        AND len(list_distinct([v.b, w.b, x.b, y.b, z.b])) = 5),
    steps AS (SELECT filter_order, k::INT AS step, bits[k] AS f, list_sum(bits[:k]) - bits[k] AS before FROM orders, range(1, 6) r(k)),
    counted AS (SELECT part, filter_order, step, f,
        sum(CASE WHEN fails & (before | f)::INT = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN fails & before::INT = 0 AND fails & f > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN fails & before::INT > 0 AND fails & f > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN fails & before::INT = 0 AND fails & f > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN fails & before::INT = 0 AND fails & f > 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM cells, steps GROUP BY part, filter_order, step, f)
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
        unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM counted
""")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), labels(spark, sf_dir))

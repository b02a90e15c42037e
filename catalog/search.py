import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import register
from catalog.identity import _sources_as_roles, restricted_items
from catalog.tables import ITEMS_SQL, documents_as_items, read
from newsledger.operators import search
from newsledger.operators.cells import VectorCells
from newsledger.plans import gap
from newsledger.session import shared_folder
from newsledger.sources.title_index import TitleIndex

_SHOWN = "title, summary, CAST(importance AS INTEGER) AS importance, category, published_epoch, url"


def _shown(found):
    return found.select(
        "title", "summary", F.col("importance").cast("int").alias("importance"), "category",
        F.unix_timestamp("published_at").alias("published_epoch"), "url",
    )


@register(
    "intel_query",
    f"""WITH {ITEMS_SQL} SELECT {_SHOWN} FROM items WHERE title ILIKE '%THE%' AND category = 'en'
    AND (doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) OR source = 'src3')
    ORDER BY published_epoch DESC NULLS FIRST, dedup_key LIMIT 20""",
)
def intel_query(spark, sf):
    roles = _sources_as_roles(spark, sf)
    return _shown(search.intel_query(restricted_items(spark, sf), "THE", "en", "src3", roles, 20))


@register(
    "title_ilike",
    f"""WITH {ITEMS_SQL} SELECT dedup_key, title FROM items WHERE title ILIKE '%TH_R%É%' OR title ILIKE '%TH_R%E%'""",
)
def title_ilike(spark, sf):
    every = documents_as_items(spark, sf).select("dedup_key", "title")
    wanted = search.title_ilike(every, "TH_R%E")
    accented = search.title_ilike(every, "TH_R%É").join(wanted, "dedup_key", "left_anti")
    return wanted.unionByName(accented)


@register(
    "title_indexed",
    f"""WITH {ITEMS_SQL}, q(query) AS (VALUES ('der'), ('TH_R%E'), ('o%\\_'), ('ÉT'), ('e'), ('no such title'))
    SELECT query, dedup_key, title FROM items JOIN q ON title ILIKE '%' || query || '%' ESCAPE '\\'""",
)
def title_indexed(spark, sf):
    """Keyword queries through a bigram index of the titles, built here for all items."""
    every = documents_as_items(spark, sf).select("dedup_key", "title")
    index = TitleIndex(spark, f"{shared_folder(spark)}/titles-{uuid.uuid4().hex}")
    index.add(every)
    found = [
        search.title_ilike(every, query, index).select(F.lit(query).alias("query"), "dedup_key", "title")
        for query in ("der", "TH_R%E", "o%\\_", "ÉT", "e", "no such title")
    ]
    return functools.reduce(DataFrame.unionByName, found)


@register(
    "topk_recent",
    f"""WITH {ITEMS_SQL} SELECT dedup_key, CASE WHEN category <> 'de' THEN published_epoch END AS published_epoch
    FROM items ORDER BY 2 DESC NULLS FIRST, dedup_key LIMIT 200""",
)
def topk_recent(spark, sf):
    every = documents_as_items(spark, sf)
    undated = F.when(F.col("category") != "de", F.col("published_at"))
    found = search.topk_recent(every.withColumn("published_at", undated), 200)
    return found.select("dedup_key", F.unix_timestamp("published_at").alias("published_epoch"))


@register(
    "top_regulations",
    f"""WITH {ITEMS_SQL} SELECT {_SHOWN} FROM items WHERE title ILIKE '%qu%' AND category = 'fr'
    ORDER BY published_epoch DESC NULLS FIRST, dedup_key LIMIT 3""",
)
def top_regulations(spark, sf):
    return _shown(gap.top_regulations(documents_as_items(spark, sf), "qu", "fr"))


TOPK_SQL = """
sims AS (SELECT q.vec_id AS query_id, d.vec_id AS doc_id,
                round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 9) AS similarity
         FROM embeddings q, embeddings d),
hits AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS rank,
                doc_id, similarity FROM sims QUALIFY rank <= 3)
"""


def _vectors(spark, sf):
    return read(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))


@register(
    "vector_topk",
    f"WITH {TOPK_SQL} SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, similarity FROM hits",
)
def vector_topk(spark, sf):
    vectors = _vectors(spark, sf)
    return search.vector_topk(
        vectors.withColumnRenamed("vec_id", "query_id"), vectors.withColumnRenamed("vec_id", "doc_id"), 3
    )


@register(
    "vector_topk_grid",
    f"WITH {TOPK_SQL} SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, similarity FROM hits",
)
def vector_topk_grid(spark, sf):
    """The same through the grid of cells, which many queries take."""
    vectors = _vectors(spark, sf)
    left, right = vectors.withColumnRenamed("vec_id", "query_id"), vectors.withColumnRenamed("vec_id", "doc_id")
    return search.vector_topk(left, right, 3, max_values=8192)


@register(
    "vector_topk_cells",
    f"WITH {TOPK_SQL} SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, similarity FROM hits",
)
def vector_topk_cells(spark, sf):
    """The same through cells, of which those are skipped that cannot hold a result."""
    vectors = _vectors(spark, sf)
    return VectorCells(vectors.withColumnRenamed("vec_id", "doc_id")).topk(vectors.withColumnRenamed("vec_id", "query_id"), 3)


@register(
    "gap_context",
    f"""WITH {TOPK_SQL}, t AS (SELECT query_id, string_agg(coalesce(text, ''), chr(10) ORDER BY rank) AS context
    FROM hits LEFT JOIN documents USING (doc_id) GROUP BY query_id)
    SELECT query_id, md5(context) AS context_md5, length(context) AS n_chars FROM t""",
)
def gap_context(spark, sf):
    context = gap.gap_context(vector_topk(spark, sf), read(spark, sf, "documents"))
    return context.select(
        "query_id", F.md5("context").alias("context_md5"),
        F.length("context").cast("bigint").alias("n_chars"),
    )


_PROMPT_SQL = f"""'{gap._TASK}' || chr(10) || '【外部法規】: ' || summary || chr(10) || '【內部系統現況】: '
    || coalesce(context, '') || chr(10) || '{gap._WANTED}'"""


@register(
    "gap_prompt",
    f"WITH {ITEMS_SQL}, p AS (SELECT dedup_key, summary, category AS context FROM items) "
    f"SELECT dedup_key, md5({_PROMPT_SQL}) AS prompt_md5 FROM p",
)
def gap_prompt(spark, sf):
    prompt = gap.gap_prompt(F.col("summary"), F.col("category"))
    return documents_as_items(spark, sf).select("dedup_key", F.md5(prompt).alias("prompt_md5"))


def _count_characters():
    return lambda prompts: [f"{len(p)} characters" for p in prompts]


@register(
    "gap_report",
    f"""WITH {ITEMS_SQL}, {TOPK_SQL},
    regs AS (SELECT i.* FROM items i WHERE title ILIKE '%the%' AND category = 'en'
             AND doc_id IN (SELECT vec_id FROM embeddings)
             ORDER BY published_epoch DESC NULLS FIRST, dedup_key LIMIT 3),
    c AS (SELECT query_id AS doc_id, string_agg(coalesce(text, ''), chr(10) ORDER BY rank) AS context
          FROM hits h LEFT JOIN documents USING (doc_id) GROUP BY query_id)
    SELECT title, length({_PROMPT_SQL}) || ' characters' AS analysis_result,
           CAST(importance AS INTEGER) AS importance FROM regs JOIN c USING (doc_id)""",
)
def gap_report(spark, sf):
    vectors = _vectors(spark, sf).withColumnRenamed("vec_id", "doc_id")
    known = documents_as_items(spark, sf).join(vectors.select("doc_id"), "doc_id", "left_semi")
    found = gap.top_regulations(known, "the", "en", more=("doc_id",)).join(vectors, "doc_id").withColumnRenamed("doc_id", "reg_id")
    report = gap.gap_report(found, vectors, read(spark, sf, "documents").select("doc_id", "text"), _count_characters)
    return report.select("title", "analysis_result", F.col("importance").cast("int").alias("importance"))

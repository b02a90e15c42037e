import json
import uuid

from pyspark.sql import functions as F

from catalog import register, sql_pii
from catalog.tables import ITEMS_SQL, documents_as_items, read
from newsledger import schema as S
from newsledger.functions import analysis as A
from newsledger.functions.vectors import safe_vector as usable_or_constant
from newsledger.operators.enrich import attach_analysis as attach
from newsledger.operators.enrich import embed as embed_rows
from newsledger.operators.enrich import enrich as enrich_rows
from newsledger.operators.quality import contract_check as check_contract
from newsledger.operators.quality import with_flags
from newsledger.plans.process import process_items
from newsledger.session import materialize, shared_folder
from newsledger.sources.answers import AnswerTable


def _prompt_sql(title: str, content: str, chars: int | None = None) -> str:
    content = content if chars is None else f"substr({content}, 1, {chars})"
    return (
        f"'{A._OPENING}' || chr(10) || '標題：' || {title} || chr(10) || '<content>' || chr(10) || "
        f"{content} || chr(10) || '</content>' || chr(10) || '{A._CLOSING}'"
    )


# -- callers' functions used for the checks: answers follow from the text alone ---------------------
def analyst():
    """Answers with the prompt's length; refuses prompts holding ``zz`` and, for ``kk``, JSON."""

    def answer(prompts):
        out = []
        for p in prompts:
            if "zz" in p:
                raise RuntimeError("refused")
            if "kk" in p:
                out.append("no json")
                continue
            n = len(p)
            out.append(
                json.dumps(
                    {
                        "summary": f"{n} characters",
                        "category": A.CATEGORIES[n % 6],
                        "importance_score": n % 10 + 1,
                        "target_roles": [A.ROLE_NAMES[n % 5]],
                        "sentiment_score": n % 11 - 5,
                        "entities": [{"type": "org", "name": str(n), "context": ""}],
                        "tags": [str(n % 7), str(n % 3)],
                        "ai_summary": f"{A.AI_SUMMARY_OPENING}{n}",
                    }
                )
            )
        return out

    return answer


def letter_counter():
    """A vector counting code points by remainder."""

    def vectors(texts):
        out = []
        for t in texts:
            v = [0.0] * S.EMBEDDING_DIM
            for c in t:
                v[ord(c) % S.EMBEDDING_DIM] += 1.0
            out.append(v)
        return out

    return vectors


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _answers_sql(relation: str, prompt: str, asked: str = "true") -> str:
    """The analyst's answer as columns next to those of ``relation``."""
    return f"""
prompted AS (SELECT *, {prompt} AS prompt, {asked} AS asked FROM {relation}),
judged AS (SELECT *, length(prompt) AS n, asked AND (contains(prompt, 'zz') OR contains(prompt, 'kk')) AS failed
           FROM prompted),
answered AS (SELECT * EXCLUDE (summary, importance),
    CASE WHEN NOT asked THEN '{S.QUARANTINE_SUMMARY}' WHEN failed THEN '{A.FALLBACK_SUMMARY}'
         ELSE n || ' characters' END AS summary,
    CASE WHEN NOT asked THEN 10 WHEN failed THEN 5 ELSE n % 10 + 1 END AS importance,
    CASE WHEN NOT asked THEN category WHEN failed THEN '{A.FALLBACK_CATEGORY}'
         ELSE {_sql_list(A.CATEGORIES)}[n % 6 + 1] END AS new_category,
    CASE WHEN NOT asked OR failed THEN 0.0 ELSE n % 11 - 5 END::DOUBLE AS sentiment,
    CASE WHEN NOT asked THEN '' WHEN failed THEN '{A.FALLBACK_AI_SUMMARY}'
         ELSE '{A.AI_SUMMARY_OPENING}' || n END AS ai_summary,
    CASE WHEN NOT asked OR failed THEN '' ELSE (n % 7) || ',' || (n % 3) END AS tags,
    CASE WHEN NOT asked OR failed THEN '' ELSE {_sql_list(A.ROLE_NAMES)}[n % 5 + 1] END AS roles
    FROM judged)"""


_TITLE_BODY = _prompt_sql("title", "body")


_CUT = _prompt_sql("title", "body", S.PROMPT_CHARS)


@register(
    "build_prompt",
    f"WITH {ITEMS_SQL} SELECT dedup_key, md5({_TITLE_BODY}) AS prompt_md5, md5({_CUT}) AS cut_md5, "
    f"length({_TITLE_BODY}) AS n_chars FROM items",
)
def build_prompt(spark, sf):
    """With the whole text, and with the bound on its length that a caller may set."""
    title, body = F.col("title"), F.col("body")
    prompt = A.build_prompt(title, body)
    return documents_as_items(spark, sf).select(
        "dedup_key", F.md5(prompt).alias("prompt_md5"), F.md5(A.build_prompt(title, body, S.PROMPT_CHARS)).alias("cut_md5"),
        F.length(prompt).cast("bigint").alias("n_chars"),
    )


@register(
    "enrich",
    f"""WITH {ITEMS_SQL}, {_answers_sql("items", _TITLE_BODY)}
    SELECT dedup_key, summary, new_category AS category, CAST(importance AS INTEGER) AS importance,
           sentiment, ai_summary, tags, roles, failed AS has_error FROM answered""",
)
def enrich(spark, sf):
    prompt = A.build_prompt(F.col("title"), F.col("body"))
    done = enrich_rows(documents_as_items(spark, sf).withColumn("prompt", prompt), "prompt", analyst)
    a = F.col("analysis")
    return done.select(
        "dedup_key", a["summary"].alias("summary"), a["category"].alias("category"),
        a["importance_score"].cast("int").alias("importance"), a["sentiment_score"].alias("sentiment"),
        a["ai_summary"].alias("ai_summary"), F.array_join(a["tags"], ",").alias("tags"),
        F.array_join(a["target_roles"], ",").alias("roles"),
        F.col("analysis_error").isNotNull().alias("has_error"),
    )


@register(
    "row_error_isolation",
    f"""WITH {ITEMS_SQL}, {_answers_sql("items", _TITLE_BODY)},
    e AS (SELECT source, CASE WHEN contains(prompt, 'zz') THEN 'RuntimeError: refused'
          WHEN contains(prompt, 'kk') THEN 'answer is not a JSON object' ELSE '' END AS error FROM answered)
    SELECT source, error, count(*) AS n_rows FROM e GROUP BY ALL""",
)
def row_error_isolation(spark, sf):
    prompt = A.build_prompt(F.col("title"), F.col("body"))
    done = enrich_rows(documents_as_items(spark, sf).withColumn("prompt", prompt), "prompt", analyst)
    error = F.coalesce("analysis_error", F.lit("")).alias("error")
    return done.groupBy("source", error).agg(F.count(F.lit(1)).alias("n_rows"))


# Answers made from the events: some are no JSON, some lack fields or hold values of a wrong type.
def _raw_answers(spark, sf):
    k = F.get_json_object("props", "$.k")
    good = F.concat(
        F.lit('{"summary": "s'), k, F.lit('", "category": "總體經濟", "importance_score": '), k,
        F.lit(', "sentiment_score": '), F.col("event_id").cast("string"),
        F.lit(', "tags": ["a", "'), k, F.lit('"], "target_roles": ["法遵長"], "ai_summary": "報告主管'), k,
        F.lit('", "entities": [{"type": "org", "name": "n'), k, F.lit('"}]}'),
    )
    raw = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("failed "), k))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"importance_score": "'), k, F.lit('", "tags": 5}')))
        .when(F.col("event_type") == "click", F.col("props"))
        .otherwise(good)
    )
    return read(spark, sf, "events").select("event_id", raw.alias("raw"))


_RAW_SQL = f"""
e AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events),
parsed AS (SELECT event_id, k,
  event_type = 'error' AS is_fallback,
  CASE event_type WHEN 'error' THEN '{A.FALLBACK_SUMMARY}' WHEN 'view' THEN NULL WHEN 'click' THEN NULL
       ELSE 's' || k END AS summary,
  CASE event_type WHEN 'error' THEN '{A.FALLBACK_CATEGORY}' WHEN 'view' THEN NULL WHEN 'click' THEN NULL
       ELSE '總體經濟' END AS category,
  CASE event_type WHEN 'error' THEN 5 WHEN 'click' THEN NULL ELSE CAST(k AS INTEGER) END AS importance,
  CASE event_type WHEN 'error' THEN 0.0 WHEN 'view' THEN NULL WHEN 'click' THEN NULL
       ELSE event_id END::DOUBLE AS sentiment,
  CASE WHEN event_type IN ('error', 'view', 'click') THEN '' ELSE 'a,' || k END AS tags,
  CASE WHEN event_type IN ('error', 'view', 'click') THEN '' ELSE '法遵長' END AS roles,
  CASE WHEN event_type IN ('error', 'view', 'click') THEN '' ELSE 'org:n' || k END AS entities,
  CASE event_type WHEN 'error' THEN '{A.FALLBACK_AI_SUMMARY}' WHEN 'view' THEN NULL WHEN 'click' THEN NULL
       ELSE '報告主管' || k END AS ai_summary FROM e)
"""


@register(
    "parse_analysis",
    f"""WITH {_RAW_SQL} SELECT event_id, is_fallback, summary, category, importance, sentiment, tags, roles,
    entities, ai_summary FROM parsed""",
)
def parse_analysis(spark, sf):
    a = F.col("a")
    names = F.transform(a["entities"], lambda e: F.concat(e["type"], F.lit(":"), e["name"]))
    return (
        _raw_answers(spark, sf)
        .withColumn("a", A.parse_analysis(F.col("raw")))
        .select(
            "event_id", a["is_fallback"].alias("is_fallback"), a["summary"].alias("summary"),
            a["category"].alias("category"), a["importance_score"].cast("int").alias("importance"),
            a["sentiment_score"].alias("sentiment"), F.array_join(a["tags"], ",").alias("tags"),
            F.array_join(a["target_roles"], ",").alias("roles"), F.array_join(names, ",").alias("entities"),
            a["ai_summary"].alias("ai_summary"),
        )
    )


@register(
    "validate_analysis",
    f"""WITH {_RAW_SQL} SELECT event_id,
    coalesce(category IN ({_sql_list(A.CATEGORIES)[1:-1]}), false) AS category_ok,
    coalesce(importance BETWEEN 1 AND 10, false) AS importance_ok, true AS roles_ok,
    coalesce(sentiment BETWEEN -5 AND 5, false) AS sentiment_ok, tags <> '' AS tags_ok,
    coalesce(starts_with(ai_summary, '報告主管') AND length(ai_summary) <= 80, false) AS ai_summary_ok
    FROM parsed""",
)
def validate_analysis(spark, sf):
    parsed = _raw_answers(spark, sf).withColumn("a", A.parse_analysis(F.col("raw")))
    return parsed.select("event_id", *[c.alias(n) for n, c in A.validate_analysis(F.col("a")).items()])


@register(
    "attach_analysis",
    f"""WITH {ITEMS_SQL} SELECT dedup_key,
    CASE category WHEN 'en' THEN 'in ' || source ELSE summary END AS summary,
    CASE category WHEN 'fr' THEN CAST(importance AS INTEGER) WHEN 'en' THEN 7 END AS importance,
    CASE category WHEN 'fr' THEN 'fr' WHEN 'en' THEN '風險管理' ELSE category END AS category,
    category <> 'fr' AS is_analyzed, CASE category WHEN 'en' THEN 2 ELSE 0 END AS n_tags FROM items""",
)
def attach_analysis(spark, sf):
    answer = F.concat(
        F.lit('{"summary": "in '), "source", F.lit('", "category": "風險管理", "importance_score": 7, "tags": ["a", "b"]}')
    )
    raw = F.when(F.col("category") == "en", answer).when(F.col("category") != "fr", F.lit("{}"))
    parsed = F.when(raw.isNotNull(), A.parse_analysis(raw))
    done = attach(documents_as_items(spark, sf).withColumn("analysis", parsed))
    return done.select(
        "dedup_key", "summary", F.col("importance").cast("int").alias("importance"), "category", "is_analyzed",
        F.size("tags").alias("n_tags"),
    )


_VECTOR_SQL = f"""
chars AS (SELECT dedup_key, ord(c) % {S.EMBEDDING_DIM} AS b FROM embedded, unnest(string_split(text, '')) AS t(c)),
vectors AS (SELECT dedup_key, CAST(count(DISTINCT b) AS INTEGER) AS n_nonzero, count(*)::DOUBLE AS total
            FROM chars GROUP BY dedup_key)
"""


@register(
    "embed",
    f"""WITH {ITEMS_SQL}, embedded AS (SELECT dedup_key, title || ' ' || summary AS text FROM items), {_VECTOR_SQL}
    SELECT dedup_key, {S.EMBEDDING_DIM} AS n_dims, n_nonzero, total FROM vectors""",
)
def embed(spark, sf):
    every = documents_as_items(spark, sf).withColumn("text", F.concat_ws(" ", "title", "summary"))
    done = embed_rows(every.select("dedup_key", "text"), "text", letter_counter)
    return done.select(
        "dedup_key", F.size("embedding").alias("n_dims"),
        F.size(F.filter("embedding", lambda x: x != 0)).alias("n_nonzero"),
        F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@register(
    "answers_by_content",
    f"""WITH {ITEMS_SQL}, {_answers_sql("items", _TITLE_BODY)},
    v AS (SELECT count(*) AS n_rows, count(DISTINCT body) AS n_texts, sum(length(body)) AS n_letters FROM items),
    a AS (SELECT count(*) AS n_rows, count(DISTINCT prompt) AS n_texts, count(DISTINCT prompt) FILTER (contains(prompt, 'zz')) AS n_refused,
      count(*) FILTER (failed) AS n_errors FROM answered)
    SELECT 'vectors' AS model, 1 AS run, n_rows, n_texts AS n_calls, 0::BIGINT AS n_errors, n_letters::DOUBLE AS total FROM v
    UNION ALL SELECT 'vectors', 2, n_rows, 0, 0, n_letters FROM v
    UNION ALL SELECT 'analysis', 1, n_rows, n_texts, n_errors, 0 FROM a
    UNION ALL SELECT 'analysis', 2, n_rows, n_refused, n_errors, 0 FROM a""",
)
def answers_by_content(spark, sf):
    """Documents with copies through two models that keep their answers, twice: texts answered once are not asked again, refused ones are."""
    items = documents_as_items(spark, sf).select("title", "body").withColumn("prompt", A.build_prompt(F.col("title"), F.col("body")))
    folder, out = f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}", None
    for run in (1, 2):
        for model in ("vectors", "analysis"):
            table, kind = AnswerTable(spark, folder, model), "array<float>" if model == "vectors" else "string"
            before = table.rows(kind).select("run").distinct()
            before = spark.createDataFrame(before.collect(), "run string")
            if model == "vectors":
                done = embed_rows(items, "body", letter_counter, answers=table).withColumn("failed", F.col("embedding_error").isNotNull())
                letters = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
            else:
                done = enrich_rows(items, "prompt", analyst, answers=table).withColumn("failed", F.col("analysis_error").isNotNull())
                letters = F.lit(0.0)
            rows = done.agg(F.count("*").alias("n_rows"), F.sum(F.col("failed").cast("long")).alias("n_errors"), F.sum(letters).alias("total"))
            calls = table.rows(kind).join(before, "run", "left_anti").agg(F.count("*").alias("n_calls"))
            counted = rows.join(calls).select(F.lit(model).alias("model"), F.lit(run).alias("run"), "n_rows", "n_calls", "n_errors", "total")
            counted = materialize(counted)
            out = counted if out is None else out.unionByName(counted)
    return out


@register(
    "safe_vector",
    """SELECT vec_id, CASE WHEN label % 3 = 2 THEN true ELSE false END AS is_kept, 64 AS n_dims,
    round(CASE WHEN label % 3 = 2 THEN embedding[1]::DOUBLE ELSE 0.00001 END, 7) AS first_value FROM embeddings""",
)
def safe_vector(spark, sf):
    case = F.col("label") % 3
    vector = (
        F.when(case == 0, F.slice("embedding", 1, 63))
        .when(case == 1, F.transform("embedding", lambda x: F.lit(0.0).cast("float")))
        .otherwise(F.col("embedding"))
    )
    done = read(spark, sf, "embeddings").withColumn("v", usable_or_constant(vector, 64))
    return done.select(
        "vec_id", (F.col("v")[1] != F.col("v")[0]).alias("is_kept"), F.size("v").alias("n_dims"),
        F.round(F.col("v")[0].cast("double"), 7).alias("first_value"),
    )


@register(
    "contract_check",
    f"""WITH {ITEMS_SQL}, c AS (SELECT sha256(body) AS key, body, summary, embedding FROM items
      LEFT JOIN embeddings ON doc_id = vec_id),
    k AS (SELECT key, count(*) AS n FROM c GROUP BY key),
    n AS (SELECT count(*) AS n_rows, CAST((SELECT sum(n) FROM k WHERE n > 1) AS BIGINT) AS key_unique,
      count(*) FILTER (length(body) < 300) AS body_long, count(*) FILTER (length(summary) < 300) AS summary_long,
      count(*) FILTER (embedding IS NULL) AS vector_usable,
      count(*) FILTER (NOT ({sql_pii.is_safe("body")}) OR NOT ({sql_pii.is_safe("summary")})) AS pii_free FROM c)
    SELECT rule, n_rows, n_failed FROM n UNPIVOT (n_failed FOR rule IN
      (key_unique, body_long, summary_long, vector_usable, pii_free))""",
)
def contract_check(spark, sf):
    vectors = with_flags(read(spark, sf, "embeddings"), "vector_usable", dim=64).select(F.col("vec_id").alias("doc_id"), "vector_usable")
    texts = with_flags(documents_as_items(spark, sf), "body_long", "summary_long", "pii_free")
    texts = texts.select("doc_id", F.sha2("body", 256).alias("dedup_key"), "body_long", "summary_long", "pii_free")
    items = texts.join(vectors, "doc_id", "left").withColumn("vector_usable", F.coalesce("vector_usable", F.lit(False)))
    return check_contract(items, dim=64)


_DONE = """SELECT dedup_key, new_category AS category, summary, CAST(importance AS INTEGER) AS importance,
    sentiment, ai_summary, tags, is_analyzed, md5(body) AS body_md5, n_nonzero FROM answered_vectors"""


def _with_vectors_sql() -> str:
    return f"""
embedded AS (SELECT dedup_key, title || ' ' || summary AS text FROM answered WHERE asked), {_VECTOR_SQL},
answered_vectors AS (SELECT a.*, asked AS is_analyzed, coalesce(n_nonzero, {S.EMBEDDING_DIM}) AS n_nonzero
                     FROM answered a LEFT JOIN vectors USING (dedup_key))"""


def shown(done):
    return done.select(
        "dedup_key", "category", "summary", F.col("importance").cast("int").alias("importance"),
        F.col("sentiment_score").alias("sentiment"), "ai_summary", F.array_join("tags", ",").alias("tags"),
        "is_analyzed", F.md5("body").alias("body_md5"),
        F.size(F.filter("embedding", lambda x: x != 0)).alias("n_nonzero"),
    )


@register(
    "process_items_quarantine",
    f"""WITH {ITEMS_SQL}, {_answers_sql("items", _TITLE_BODY, sql_pii.is_safe("body"))}, {_with_vectors_sql()} {_DONE}""",
)
def process_items_quarantine(spark, sf):
    return shown(process_items(documents_as_items(spark, sf), analyst, letter_counter, keep=False))


MASKED_SQL = f"""
masked AS (SELECT * REPLACE ({sql_pii.mask("body")} AS body) FROM items),
{_answers_sql("masked", _TITLE_BODY)}, {_with_vectors_sql()} """


@register("process_items_mask", f"WITH {ITEMS_SQL}, {MASKED_SQL} {_DONE}")
def process_items_mask(spark, sf):
    return shown(process_items(documents_as_items(spark, sf), analyst, letter_counter, "mask", keep=False))

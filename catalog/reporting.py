from pyspark.sql import functions as F

from catalog import register
from catalog.tables import ITEMS_SQL, documents_as_items, read
from newsledger.functions import reports as R
from newsledger.operators import reports


@register(
    "report_rows",
    """SELECT doc_id, lang, CAST(NULL AS BIGINT) AS p_partkey, NULL AS p_name FROM documents
    UNION ALL SELECT NULL, NULL, p_partkey, p_name FROM part""",
)
def report_rows(spark, sf):
    return reports.report_rows(
        read(spark, sf, "documents").select("doc_id", "lang"), read(spark, sf, "part").select("p_partkey", "p_name")
    )


_EVENT_KEYS = ("click", "error", "purchase", "signup", "view")


@register(
    "report_rows_of_objects",
    "SELECT event_id, " + ", ".join(f"CASE WHEN event_type = '{t}' THEN value END AS {t}" for t in _EVENT_KEYS) + """,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS who FROM events""",
)
def report_rows_of_objects(spark, sf):
    """The events' JSON properties, each with its value under a key of its type, as one table."""
    who = F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    text = F.concat(F.rtrim(F.col("props"), F.lit("} ")), F.lit(', "'), "event_type", F.lit('": '), F.col("value").cast("string"), F.lit(', "who": '), who, F.lit("}"))
    rows = read(spark, sf, "events").select("event_id", F.parse_json(text).alias("row"))
    found = reports.rows_of_objects(rows, "row", keep=("event_id",))
    return found.withColumns({c: F.col(c).cast("double") for c in _EVENT_KEYS if c in found.columns})


_PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")


@register(
    "column_widths",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(least(50, greatest({len(c) + 2}, max(length(coalesce({v}::VARCHAR, 'None')))))"
        f" AS INTEGER) AS width FROM {t}"
        for t, columns in (("part", [(c, c) for c in _PART_COLUMNS]), ("documents", [("text", "text"), ("lang", "CASE WHEN lang <> 'en' THEN lang END")]))
        for c, v in columns
    ),
)
def column_widths(spark, sf):
    docs = read(spark, sf, "documents").select("text", F.expr("CASE WHEN lang <> 'en' THEN lang END").alias("lang"))
    parts = reports.column_widths(read(spark, sf, "part").select(*_PART_COLUMNS))
    return parts.unionByName(reports.column_widths(docs))


@register(
    "report_lines",
    f"""WITH {ITEMS_SQL}, r AS (SELECT dedup_key,
      '【' || coalesce(CASE WHEN category = 'en' THEN title END, CASE WHEN category <> 'de' THEN source END, '{R.UNNAMED}')
      || '】: ' || coalesce(CASE WHEN category <> 'es' THEN summary END, body) AS t FROM items)
    SELECT dedup_key, CAST(i AS INTEGER) AS line_no, substr(t, 60 * i + 1, 60) AS line
    FROM r, range(0, 5) AS lines(i) WHERE length(t) > 60 * i""",
)
def report_lines(spark, sf):
    lang = F.col("category")
    rows = documents_as_items(spark, sf).select(
        "dedup_key",
        F.when(lang == "en", F.col("title")).alias("title"),
        F.when(lang != "de", F.col("source")).alias("name"),
        F.when(lang != "es", F.col("summary")).alias("summary"),
        F.col("body").alias("content"),
    )
    return reports.report_line_rows(rows, ["dedup_key"])


def _templates(spark, sf):
    lang = F.col("lang")
    return read(spark, sf, "documents").select(
        "doc_id",
        F.when(lang == "en", F.lit("{{ source }}")).when(lang == "fr", F.lit("{{unknown}}"))
        .when(lang == "de", F.lit("source")).otherwise(F.lit("{{lang}}")).alias("cell"),
        F.concat(F.lit("{{source}} / {{ lang }} / {{lang}}: "), "text").alias("body"),
        F.when(lang == "en", F.lit("../a/sheet.xlsx")).when(lang == "fr", F.lit("b/deck.pptx"))
        .otherwise(F.lit("note.docx")).alias("file"),
        F.create_map(F.lit("source"), F.col("source"), F.lit("lang"), lang).alias("data"),
    )


_CELL_SQL = "CASE lang WHEN 'en' THEN source WHEN 'fr' THEN '{{unknown}}' WHEN 'de' THEN 'source' ELSE lang END"
_TEXT_SQL = "replace(replace('{{source}} / {{ lang }} / {{lang}}: ' || text, '{{source}}', source), '{{lang}}', lang)"


@register("template_cell", f"SELECT doc_id, {_CELL_SQL} AS filled FROM documents")
def template_cell(spark, sf):
    return _templates(spark, sf).select("doc_id", R.template_cell(F.col("cell"), F.col("data")).alias("filled"))


@register("template_text", f"SELECT doc_id, {_TEXT_SQL} AS filled FROM documents")
def template_text(spark, sf):
    return _templates(spark, sf).select("doc_id", R.template_text(F.col("body"), F.col("data")).alias("filled"))


@register(
    "template_route",
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'sheet.xlsx' WHEN 'fr' THEN 'deck.pptx' ELSE 'note.docx' END AS file,
    CASE lang WHEN 'en' THEN source WHEN 'fr' THEN '{{unknown}}' ELSE '' END AS filled FROM documents""",
)
def template_route(spark, sf):
    name = F.col("file")
    return _templates(spark, sf).select(
        "doc_id", R.template_file(name).alias("file"),
        R.template_route(name, F.col("cell"), F.col("data")).alias("filled"),
    )

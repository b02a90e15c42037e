"""Comparing new regulations with internal documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsledger.functions.text import or_empty
from newsledger.operators.enrich import Factory, call_model
from newsledger.operators.search import intel_query, vector_topk
from newsledger.session import materialize

# What the report asks for and says.
KEYWORD, CATEGORY, TOP_REGULATIONS, TOP_DOCUMENTS = "資安", "法遵", 3, 3
NO_CHANGES = "目前無重大相關法規異動。"
_TASK = "以下為一則新法規，以及與其最接近的內部文件。請說明公司目前的做法離法規還有多遠。"
_WANTED = "回答分四段：法規規定了什麼、公司已做到什麼、差距屬於大、中或小、接下來該改什麼。"


def top_regulations(
    items: DataFrame, keyword: str = KEYWORD, category: str = CATEGORY, limit: int = TOP_REGULATIONS, more: tuple[str, ...] = ()
) -> DataFrame:
    """The newest regulations by keyword and category; no row means there are no changes to report."""
    return intel_query(items, keyword, category, limit=limit, more=more)


def regulations_message(regulations: DataFrame) -> str | None:
    return NO_CHANGES if regulations.isEmpty() else None


def gap_context(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """``(query_id, context)``: the texts of a query's hits in rank order, one per line.

    Only documents that were hit are joined; a query has at most k of them.
    """
    texts = hits.join(documents.select("doc_id", "text"), "doc_id", "left")
    return texts.groupBy("query_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", or_empty(F.col("text")).alias("text")))),
                lambda h: h["text"],
            ),
            "\n",
        ).alias("context")
    )


def gap_prompt(regulation: Column, context: Column) -> Column:
    return F.concat(
        F.lit(_TASK + "\n【外部法規】: "),
        or_empty(regulation),
        F.lit("\n【內部系統現況】: "),
        or_empty(context),
        F.lit("\n" + _WANTED),
    )


def gap_report(
    regulations: DataFrame, vectors: DataFrame, texts: DataFrame, factory: Factory, k: int = TOP_DOCUMENTS
) -> DataFrame:
    """``(title, analysis_result, importance, analysis_error)`` per regulation.

    ``regulations (reg_id, title, summary, importance, vector)``, ``vectors (doc_id, vector)``, ``texts (doc_id, text)``;
    texts are joined to hits only. The model answers in free text.
    """
    # A handful of rows, but costly to find: kept, so the item table is searched once.
    regulations = materialize(regulations)
    hits = vector_topk(regulations.select(F.col("reg_id").alias("query_id"), "vector"), vectors, k)
    context = gap_context(hits, texts).withColumnRenamed("query_id", "reg_id")
    asked = regulations.join(context, "reg_id", "left").withColumn(
        "__prompt", gap_prompt(F.col("summary"), F.col("context"))
    )
    answered = call_model(asked, "__prompt", factory, "analysis_result", "analysis_error")
    return answered.select("title", "analysis_result", "importance", "analysis_error")

"""Table schemas and the fixed values stored with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("type", "name", "context")]
)

ITEMS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("importance", T.ShortType()),
        T.StructField("target_roles", T.ArrayType(T.StringType())),
        T.StructField("dedup_key", T.StringType()),
        T.StructField("is_analyzed", T.BooleanType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("entities", T.ArrayType(ENTITY)),
        T.StructField("ai_summary", T.StringType()),
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("created_at", T.TimestampType()),
    ]
)

ROLES = T.StructType(
    [
        T.StructField("role_id", T.StringType(), False),
        T.StructField("role_name", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

PREFERENCES = T.StructType(
    [
        T.StructField("role_name", T.StringType(), False),
        T.StructField("preferences", T.MapType(T.StringType(), T.StringType())),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

STREAM_RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("source", "payload", "pipeline_run_id")]
)

# --------------------------------------------------------------------------------------------------
# Fixed values.
# --------------------------------------------------------------------------------------------------
SCRAPE_CATEGORY = "scrape"
SUMMARY_CHARS = 600
PROMPT_CHARS = 3000
EMBEDDING_DIM = 768
SAFE_VECTOR_VALUE = 1e-5
QUARANTINE_SUMMARY = "[內容過於敏感，地端隔離處理中]"
QUARANTINE_IMPORTANCE = 10
UNKNOWN_SOURCE = "unknown"

SAFE_COLUMNS = (
    "id", "source", "title", "category", "summary", "body", "url",
    "published_at", "importance", "dedup_key", "is_analyzed",
    "sentiment_score", "tags", "entities", "ai_summary", "pipeline_run_id", "embedding",
)
RECORD_COLUMNS = (
    "id", "source", "title", "category", "summary", "body", "url", "published_at", "importance",
    "target_roles", "dedup_key", "is_analyzed", "sentiment_score", "tags", "entities", "ai_summary",
    "pipeline_run_id",
)

SEED_ROLES = (
    ("董事長", "決策核心，關注總體策略與重大風險"),
    ("法遵長", "合規把關，關注金管會裁罰與法規更新"),
    ("資訊長", "技術引領，關注資安、金融科技與 AI 發展"),
    ("營運長", "業務推動，關注同業動態與市場營運"),
    ("風險長", "風險控管，關注信用、市場及營運風險"),
)
# --------------------------------------------------------------------------------------------------


def empty_array(element: T.DataType | None = None) -> Column:
    return F.array().cast(T.ArrayType(element or T.StringType()))


def item_defaults() -> dict[str, Column]:
    """Values a new row takes for the columns it does not bring along."""
    return {
        "id": F.uuid(),
        "importance": F.lit(5).cast("short"),
        "target_roles": empty_array(),
        "is_analyzed": F.lit(False),
        "sentiment_score": F.lit(0.0),
        "tags": empty_array(),
        "entities": empty_array(ENTITY),
        "created_at": F.current_timestamp(),
    }

import uuid

from pyspark.sql import functions as F

from catalog import register
from catalog.tables import ITEMS_SQL, documents_as_items, read
from newsledger import schema as S
from newsledger.functions.urls import dedup_key as key_of
from newsledger.operators import items, roles, stored
from newsledger.session import shared_folder
from newsledger.sources.item_table import ItemTable

# Stored rows and incoming rows overlap in French; together they are the whole table.
STORED_LANGS, INCOMING_LANGS = ("en", "fr"), ("fr", "de", "es")
_STORED = "category IN ('en', 'fr')"
_INCOMING = "category IN ('fr', 'de', 'es')"


def _split(spark, sf):
    every = documents_as_items(spark, sf)
    return (
        every.filter(F.col("category").isin(*STORED_LANGS)),
        every.filter(F.col("category").isin(*INCOMING_LANGS)),
    )


@register("dedup_key", "SELECT page_id, sha256(url || html) AS dedup_key FROM pages")
def dedup_key(spark, sf):
    return read(spark, sf, "pages").select("page_id", key_of(F.col("url"), F.col("html")).alias("dedup_key"))


@register(
    "union_sources",
    f"""WITH {ITEMS_SQL}, both_ AS (
      SELECT source, title, body FROM items
      UNION ALL SELECT role, split_part(text, chr(10), 1), text FROM conversations)
    SELECT source, count(*) AS n_items, CAST(sum(length(body)) AS BIGINT) AS n_chars FROM both_ GROUP BY source""",
)
def union_sources(spark, sf):
    talk = read(spark, sf, "conversations").select(
        F.col("role").alias("source"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("body")
    )
    both = items.union_sources(documents_as_items(spark, sf).select("source", "title", "body"), talk)
    return both.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum(F.length("body")).alias("n_chars")
    )


@register(
    "new_items",
    f"""WITH {ITEMS_SQL} SELECT dedup_key, url, md5(body) AS body_md5 FROM items i WHERE {_INCOMING}
    AND NOT EXISTS (SELECT 1 FROM items s WHERE s.{_STORED} AND s.url = i.url)""",
)
def new_items(spark, sf):
    old, new = _split(spark, sf)
    return stored.new_items(new, old).select("dedup_key", "url", F.md5("body").alias("body_md5"))


@register(
    "existing_urls",
    f"""WITH {ITEMS_SQL} SELECT DISTINCT url FROM items WHERE {_INCOMING}
    AND url IN (SELECT url FROM items WHERE {_STORED})""",
)
def existing_urls(spark, sf):
    old, new = _split(spark, sf)
    return stored.existing_urls(new, old)


def _split_with_filters(spark, sf):
    """Stored and incoming rows; the stored ones are a table of the item writer's layout."""
    old, new = _split(spark, sf)
    table = ItemTable(spark, f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}")
    table.append(old)
    return table.read(), new


@register(
    "new_items_filtered",
    f"""WITH {ITEMS_SQL} SELECT dedup_key, url, md5(body) AS body_md5 FROM items i WHERE {_INCOMING}
    AND NOT EXISTS (SELECT 1 FROM items s WHERE s.{_STORED} AND s.url = i.url)""",
)
def new_items_filtered(spark, sf):
    """As ``new_items``, with the incoming URLs as a filter on the stored table's scan as long as they are few."""
    old, new = _split_with_filters(spark, sf)
    return stored.new_items(new, stored.having(old, new, "url")).select("dedup_key", "url", F.md5("body").alias("body_md5"))


@register(
    "existing_urls_filtered",
    f"""WITH {ITEMS_SQL} SELECT DISTINCT url FROM items WHERE {_INCOMING}
    AND url IN (SELECT url FROM items WHERE {_STORED})""",
)
def existing_urls_filtered(spark, sf):
    old, new = _split_with_filters(spark, sf)
    return stored.existing_urls(new, stored.having(old, new, "url"))


@register(
    "url_exists",
    f"""WITH {ITEMS_SQL} SELECT dedup_key, url IN (SELECT url FROM items WHERE {_STORED}) AS is_stored
    FROM items WHERE {_INCOMING}""",
)
def url_exists(spark, sf):
    old, new = _split(spark, sf)
    return stored.url_exists(new, old).select("dedup_key", "is_stored")


@register(
    "upsert_items",
    f"""WITH {ITEMS_SQL},
    old AS (SELECT * FROM items WHERE {_STORED}),
    new AS (SELECT dedup_key, source, title, url, 'new: ' || summary AS summary,
                   CASE WHEN importance > 1 THEN 9 END AS importance FROM items WHERE {_INCOMING})
    SELECT dedup_key, coalesce(n.source, o.source) AS source,
           CASE WHEN n.url IS NOT NULL THEN n.summary ELSE o.summary END AS summary,
           CAST(CASE WHEN n.url IS NOT NULL THEN n.importance ELSE o.importance END AS INTEGER) AS importance,
           o.category AS category, length(o.body) AS n_body, false AS is_analyzed,
           0 AS n_tags, 0.0::DOUBLE AS sentiment_score
    FROM old o FULL OUTER JOIN new n USING (dedup_key)""",
)
def upsert_items(spark, sf):
    old, new = _split(spark, sf)
    change = new.select(
        "dedup_key", "source", "title", "url", F.concat(F.lit("new: "), "summary").alias("summary"),
        F.when(F.col("importance") > 1, F.lit(9).cast("short")).alias("importance"),
    )
    return stored.upsert_items(old, change).select(
        "dedup_key", "source", "summary", F.col("importance").cast("int").alias("importance"), "category",
        F.length("body").cast("bigint").alias("n_body"), "is_analyzed", F.size("tags").alias("n_tags"),
        "sentiment_score",
    )


@register(
    "insert_if_absent",
    f"""WITH {ITEMS_SQL}, k AS (SELECT sha256(body) AS body_key, category FROM items)
    SELECT DISTINCT body_key FROM k WHERE {_INCOMING}
    AND body_key NOT IN (SELECT body_key FROM k WHERE {_STORED})""",
)
def insert_if_absent(spark, sf):
    old, new = (d.select(F.sha2("body", 256).alias("body_key")) for d in _split(spark, sf))
    return stored.insert_if_absent(new, old, "body_key")


def _customers_as_roles(spark, sf):
    return read(spark, sf, "customer").select(
        F.concat(F.lit("role-"), F.col("c_custkey").cast("string")).alias("role_id"),
        F.col("c_name").alias("role_name"),
    )


@register("role_map", "SELECT c_name AS role_name, 'role-' || c_custkey AS role_id FROM customer")
def role_map(spark, sf):
    return roles.role_map(_customers_as_roles(spark, sf))


def _sources_as_roles(spark, sf):
    names = read(spark, sf, "documents").select(F.col("source").alias("role_name")).distinct()
    return names.select(F.md5("role_name").alias("role_id"), "role_name")


@register(
    "roles_to_ids",
    f"""WITH {ITEMS_SQL}, orders_ AS (SELECT dedup_key, list_sort(list_distinct([md5(source)])) AS ids FROM items)
    SELECT dedup_key, ids[1] AS first_id, CAST(len(ids) AS INTEGER) AS n_ids FROM orders_""",
)
def roles_to_ids(spark, sf):
    named = documents_as_items(spark, sf).withColumn("role_names", F.array("category", "source", "source"))
    done = roles.roles_to_ids(named, _sources_as_roles(spark, sf))
    return done.select(
        "dedup_key", F.get("target_roles", F.lit(0)).alias("first_id"), F.size("target_roles").alias("n_ids")
    )


def restricted_items(spark, sf):
    """Documents labelled toxic are for the role of their source only, the others for everybody."""
    toxic = read(spark, sf, "labels").filter("toxic = 1").select("doc_id").distinct()
    toxic = toxic.withColumn("is_toxic", F.lit(True))
    every = documents_as_items(spark, sf).join(toxic, "doc_id", "left")
    only = F.when(F.col("is_toxic"), F.array(F.md5("source"))).otherwise(S.empty_array())
    return every.withColumn("target_roles", only).drop("is_toxic")


@register(
    "role_filter",
    f"""WITH {ITEMS_SQL} SELECT dedup_key, source FROM items
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) OR source = 'src3'""",
)
def role_filter(spark, sf):
    found = roles.role_filter(restricted_items(spark, sf), _sources_as_roles(spark, sf), "src3")
    return found.select("dedup_key", "source")


@register(
    "preferences_get",
    """SELECT event_type AS role_name, json_extract_string(props, '$.k') AS k FROM events
    WHERE event_type = 'purchase' ORDER BY ts DESC, props DESC LIMIT 1""",
)
def preferences_get(spark, sf):
    rows = read(spark, sf, "events").select(
        F.col("event_type").alias("role_name"),
        F.from_json("props", "map<string,string>").alias("preferences"),
        F.col("ts").alias("updated_at"),
    )
    return roles.preferences_get(rows, "purchase").select("role_name", F.col("preferences")["k"].alias("k"))


def _preferences(events, kinds):
    counts = (
        events.filter(F.col("event_type").isin(*kinds))
        .groupBy("user_id", "event_type")
        .agg(F.count(F.lit(1)).cast("string").alias("n"))
    )
    # one entry per event type, so the list per user is bounded
    return counts.groupBy(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("role_name")).agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("preferences")
    )


@register(
    "preferences_upsert",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n, event_type IN ('purchase', 'signup') AS is_new
       FROM events GROUP BY ALL),
    t AS (SELECT 'user' || user_id AS role_name, bool_or(is_new) AS is_stamped,
          string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS preferences FROM c GROUP BY user_id)
    SELECT role_name, preferences, is_stamped FROM t""",
)
def preferences_upsert(spark, sf):
    events = read(spark, sf, "events")
    at = F.lit(None).cast("timestamp")
    old = _preferences(events, ("view", "click", "error")).withColumn("updated_at", at)
    new = _preferences(events, ("purchase", "signup"))
    done = roles.preferences_upsert(old, new)
    pairs = F.transform(
        F.array_sort(F.map_entries("preferences")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return done.select(
        "role_name", F.array_join(pairs, ",").alias("preferences"),
        F.col("updated_at").isNotNull().alias("is_stamped"),
    )

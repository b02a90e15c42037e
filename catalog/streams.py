import uuid

from pyspark.sql import functions as F

from catalog import register, sql_pii
from catalog.enrichment import _DONE, _TITLE_BODY, MASKED_SQL, _answers_sql, _with_vectors_sql, analyst, letter_counter, shown
from catalog.extraction import ENTRIES_SQL, RUN_ID, page_entries
from catalog.tables import ITEMS_SQL, documents_as_items, read
from newsledger import schema as S
from newsledger.operators.items import to_items
from newsledger.operators.quality import ContractCounts
from newsledger.plans.store import write_items
from newsledger.session import materialize, shared_folder
from newsledger.sources.item_table import ItemTable
from newsledger.streaming import ingest


def new_folder(spark) -> str:
    """A folder of its own below the cluster's shared checkpoint folder."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


@register(
    "publish_stream",
    f"""WITH {ITEMS_SQL} SELECT source, md5(to_json({{'title': title, 'url': url, 'body': body,
    'dedup_key': dedup_key}})::VARCHAR) AS payload_md5 FROM items""",
)
def publish_stream(spark, sf):
    return ingest.stream_records(documents_as_items(spark, sf)).select("source", F.md5("payload").alias("payload_md5"))


@register(
    "consume_stream",
    f"""WITH {ITEMS_SQL} SELECT source, md5(to_json({{'title': title, 'url': url, 'body': body,
    'dedup_key': dedup_key}})::VARCHAR) AS payload_md5 FROM items""",
)
def consume_stream(spark, sf):
    """Publishes the documents as files and reads every record of the stream exactly once."""
    root = new_folder(spark)
    ingest.publish(documents_as_items(spark, sf), f"{root}/records")
    ingest.read_records(spark, f"{root}/records", 2).writeStream.format("parquet").option(
        "checkpointLocation", f"{root}/checkpoint"
    ).trigger(availableNow=True).start(f"{root}/read").awaitTermination()
    return spark.read.parquet(f"{root}/read").select("source", F.md5("payload").alias("payload_md5"))


def _records(spark, sf):
    """Events as stream records: some without source, title or run id, some unreadable."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    full = F.concat(F.lit('{"title": "t'), number, F.lit('", "url": "/u/'), F.col("user_id").cast("string"),
                    F.lit("-"), F.get_json_object("props", "$.k"), F.lit('", "body": "b'), number, F.lit('"}'))
    payload = (
        F.when(kind == "error", F.concat(F.lit("broken "), number))
        .when(kind == "view", F.col("props"))
        .when(kind == "signup", F.lit(None))
        .otherwise(full)
    )
    run = F.when(kind == "click", F.lit("")).when(kind == "view", F.lit("not-a-uuid")).when(
        kind == "purchase", F.concat(F.lit("{"), F.upper(F.substring(F.md5(number), 1, 32)), F.lit("}"))
    )
    return read(spark, sf, "events").select(
        "event_id", F.when(kind != "click", kind).alias("source"), payload.alias("payload"), run.alias("pipeline_run_id")
    )


_RECORDS_SQL = """
decoded AS (SELECT event_id, user_id, event_type, CASE event_type WHEN 'click' THEN 'unknown' ELSE event_type END AS source,
  CASE WHEN event_type IN ('click', 'purchase') THEN 't' || event_id ELSE '' END AS title,
  CASE WHEN event_type IN ('click', 'purchase') THEN '/u/' || user_id || '-' || json_extract_string(props, '$.k') ELSE '' END AS url,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'b' || event_id ELSE '' END AS body,
  CASE WHEN event_type = 'purchase' THEN regexp_replace(md5(event_id::VARCHAR), '^(.{8})(.{4})(.{4})(.{4})(.{12})$',
       '\\1-\\2-\\3-\\4-\\5') END AS pipeline_run_id,
  CASE event_type WHEN 'error' THEN 'payload is not a JSON object' WHEN 'view' THEN 'pipeline_run_id is not a UUID' END
    AS decode_error FROM events)
"""


@register(
    "decode_record",
    f"""WITH {_RECORDS_SQL} SELECT source, title, url, body, pipeline_run_id, decode_error, count(*) AS n
    FROM decoded GROUP BY ALL""",
)
def decode_record(spark, sf):
    decoded = ingest.decode_records(_records(spark, sf))
    columns = ("source", "title", "url", "body", "pipeline_run_id", "decode_error")
    return decoded.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


@register(
    "idempotent_skip",
    f"""WITH {_RECORDS_SQL}, stored AS (SELECT DISTINCT url FROM decoded WHERE event_type = 'purchase')
    SELECT url, coalesce('t' || min(CASE WHEN title <> '' THEN event_id END), '') AS title FROM decoded WHERE decode_error IS NULL
    AND url NOT IN (SELECT url FROM stored) GROUP BY url""",
)
def idempotent_skip(spark, sf):
    """The first event per URL, out of a stream of three micro-batches in the order of the events."""
    root = new_folder(spark)
    records = _records(spark, sf)
    last = records.agg(F.max("event_id")).first()[0] or 0
    for k in range(3):
        third = F.least(F.floor(F.col("event_id") * 3 / (last + 1)), F.lit(2))
        records.filter(third == k).coalesce(1).write.mode("append").json(f"{root}/records")
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).json(f"{root}/records")
    decoded = ingest.decode_records(stream.withColumnRenamed("event_id", "arrived"))
    stored = ingest.decode_records(records).filter(F.col("source") == "purchase").select("url").distinct()

    def work(batch, _):
        unseen = ingest.of_new_urls(batch)
        ingest.fresh_records(unseen, stored).select("url", "title").write.mode("append").parquet(f"{root}/fresh")

    unseen = ingest.unseen_records(decoded).writeStream.foreachBatch(ingest.each_batch(work, spark))
    writer = unseen.option("checkpointLocation", f"{root}/checkpoint")
    ingest.start(writer.trigger(availableNow=True), spark).awaitTermination()
    return spark.read.schema("url string, title string").parquet(f"{root}/fresh")


@register(
    "ack_or_retry",
    f"""WITH {_RECORDS_SQL}, bad AS (SELECT decode_error, count(*) AS n FROM decoded WHERE decode_error IS NOT NULL GROUP BY ALL)
    SELECT decode_error, 3 * n AS n_records, n AS n_replayed FROM bad""",
)
def ack_or_retry(spark, sf):
    """Unreadable records of a stream over the events end up in the dead-letter folder, nothing else.

    A second worker with a checkpoint of its own adds its letters, the first one's stay. Replaying publishes each letter once;
    running the replay again publishes nothing.
    """
    root = new_folder(spark)
    _records(spark, sf).drop("event_id").write.json(f"{root}/records")
    table = ItemTable(spark, f"{root}/items")

    def work(checkpoint, records):
        ingest.start_worker(
            ingest.read_records(spark, records, 4), table, f"{root}/{checkpoint}", f"{root}/dead", analyst, letter_counter,
            available_now=True,
        ).awaitTermination()

    work("first", f"{root}/records")
    ingest.replay_dead_letters(spark, f"{root}/dead", f"{root}/again")
    ingest.replay_dead_letters(spark, f"{root}/dead", f"{root}/again")
    work("second", f"{root}/records")
    work("third", f"{root}/again")
    letters = ingest.dead_letters_of(spark, f"{root}/dead").groupBy("decode_error").agg(F.count(F.lit(1)).alias("n_records"))
    again = spark.read.schema(S.STREAM_RECORD).json(f"{root}/again").select(F.lit("").alias("source"), "payload", "pipeline_run_id")
    replayed = ingest.decode_records(again).groupBy("decode_error").agg(F.count(F.lit(1)).alias("n_replayed"))
    return letters.join(replayed, "decode_error")


@register("stream_ingest", f"WITH {ITEMS_SQL}, {MASKED_SQL} {_DONE}")
def stream_ingest(spark, sf):
    """Publishes the documents, works the stream off in micro-batches and reads the table back."""
    root = new_folder(spark)
    ingest.publish(documents_as_items(spark, sf), f"{root}/records")
    table = ItemTable(spark, f"{root}/items")
    ingest.start_worker(
        ingest.read_records(spark, f"{root}/records"), table, f"{root}/checkpoint", f"{root}/dead", analyst,
        letter_counter, available_now=True,
    ).awaitTermination()
    return shown(table.read())


@register(
    "batch_job",
    f"""WITH {ENTRIES_SQL}, page_items AS (SELECT *, sha256(url || title) AS dedup_key, 5 AS importance,
      '{S.SCRAPE_CATEGORY}' AS category, substr(body, 1, {S.SUMMARY_CHARS}) AS summary FROM entries),
    {_answers_sql("page_items", _TITLE_BODY, sql_pii.is_safe("body"))}, {_with_vectors_sql()} {_DONE}""",
)
def batch_job(spark, sf):
    """Text out of every page, items, quarantine or analysis, vectors, into the table and back."""
    table = ItemTable(spark, f"{new_folder(spark)}/items")
    write_items(table, to_items(page_entries(spark, sf), RUN_ID), analyst, letter_counter)
    return shown(table.read())


@register(
    "contract_on_write",
    f"""WITH {ITEMS_SQL}, {MASKED_SQL}, n AS (SELECT count(*) AS n_rows, 0 AS key_unique,
      count(*) FILTER (length(body) < 300) AS body_long, count(*) FILTER (length(summary) < 300) AS summary_long,
      count(*) FILTER (n_nonzero = 0) AS vector_usable,
      count(*) FILTER (NOT ({sql_pii.is_safe("body")}) OR NOT ({sql_pii.is_safe("summary")})) AS pii_free FROM answered_vectors)
    SELECT rule, n_rows, CAST(n_failed AS BIGINT) AS n_failed FROM n UNPIVOT (n_failed FOR rule IN
      (key_unique, body_long, summary_long, vector_usable, pii_free))""",
)
def contract_on_write(spark, sf):
    """All documents through the masking batch job, the contract counted by the job that writes them."""
    table, counts = ItemTable(spark, f"{new_folder(spark)}/items"), ContractCounts()
    write_items(table, documents_as_items(spark, sf), analyst, letter_counter, policy="mask", counts=counts)
    return counts.rows(spark)

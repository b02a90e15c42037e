"""Publishing new items as stream records and working them off.

Records are JSON files in a shared folder; a log source with the same three columns can stand in for
them. Progress lives in the query's checkpoint: a micro-batch counts as read once its rows are written.

URLs are compared twice. The query keeps the URLs it has seen as keyed state, each for a time limit, and marks those that are new in a micro-batch;
records of other URLs are dropped before any table is read, and a micro-batch without new URLs reads none. Only keys go to the state, never texts. What passes is compared with the stored table, which also knows URLs of other
queries and of times past the limit. A batch run again writes nothing twice: it starts from the state before it, and stored URLs are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from newsledger import schema as S
from newsledger.functions.analysis import json_object
from newsledger.functions.text import let
from newsledger.operators.enrich import Factory
from newsledger.operators.items import to_items
from newsledger.operators.ranking import first_per_group
from newsledger.operators.stored import having, new_items
from newsledger.plans.store import write_items
from newsledger.sources.item_table import ItemTable


def stream_records(items: DataFrame) -> DataFrame:
    """``(source, payload, pipeline_run_id)`` with the payload as JSON text."""
    payload = F.to_json(
        F.struct("title", "url", "body", "dedup_key"), {"ignoreNullFields": "false"}
    )
    return items.select("source", payload.alias("payload"), "pipeline_run_id")


def publish(items: DataFrame, folder: str) -> None:
    """Adds the items as records to the folder the stream reads."""
    stream_records(items).write.mode("append").json(folder)


def read_records(spark: SparkSession, folder: str, max_files: int | None = None, max_bytes: int = 1 << 30) -> DataFrame:
    """The folder as a stream, from its beginning, with ``arrived`` to tell earlier records from later ones.

    A micro-batch takes at most ``max_bytes`` of files (or ``max_files`` files); the rest waits for the next one.
    """
    reader = spark.readStream.schema(S.STREAM_RECORD)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader.option("maxBytesPerTrigger", max_bytes)
    arrived = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start").alias("arrived")
    return reader.json(folder).select("*", arrived)


def records_from_log(log: DataFrame, value: str = "value") -> DataFrame:
    """Records out of a log source whose ``value`` holds one JSON object per record.

    The log's own start setting decides what is read first: from the beginning, or, as a consumer which
    only wants what arrives from now on, from its end.
    """
    fields = F.from_json(F.col(value).cast("string"), S.STREAM_RECORD)
    known = [c for c in ("timestamp", "partition", "offset") if c in log.columns]
    arrived = [F.struct(*known).alias("arrived")] if known else []
    return log.select(fields.alias("record"), *arrived).select("record.*", *["arrived"] * bool(known))


def canonical_uuid(text: Column) -> Column:
    """A UUID in hyphenated lower-case form, null for any other text."""
    digits = F.regexp_replace(F.regexp_replace(text, "urn:|uuid:", ""), r"^[{}]+|[{}]+$|-", "")
    return F.when(
        digits.rlike("^[0-9a-fA-F]{32}$"),
        F.regexp_replace(
            F.lower(digits), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
        ),
    )


def decode_records(records: DataFrame) -> DataFrame:
    """``(source, title, url, body, pipeline_run_id, decode_error)`` next to the raw payload.

    Missing fields take their defaults; a payload which is no JSON object and a run id which is no UUID
    set ``decode_error``. ``arrived`` and ``row``, if there are, go along.
    """
    order = [c for c in ("arrived", "row") if c in records.columns]
    fields = json_object(F.coalesce("payload", F.lit("{}")))
    run = F.when(F.col("pipeline_run_id") != "", F.col("pipeline_run_id"))
    # Two steps, so that the payload is parsed once for all its fields.
    parsed = records.select(
        F.coalesce("source", F.lit(S.UNKNOWN_SOURCE)).alias("source"),
        let(
            fields,
            lambda f: F.struct(
                f.isNotNull().alias("readable"),
                *[F.coalesce(f[c], F.lit("")).alias(c) for c in ("title", "url", "body")],
            ),
        ).alias("fields"),
        canonical_uuid(run).alias("run_id"),
        "payload",
        run.alias("raw_run_id"),
        *order,
    )
    error = F.when(~F.col("fields.readable"), "payload is not a JSON object").when(
        F.col("raw_run_id").isNotNull() & F.col("run_id").isNull(), "pipeline_run_id is not a UUID"
    )
    return parsed.select(
        "source", "fields.title", "fields.url", "fields.body", F.col("run_id").alias("pipeline_run_id"),
        "payload", "raw_run_id", error.alias("decode_error"), *order,
    )


SEEN_FOR_HOURS = 24 * 7
# What a query with keyed state and time limits runs with: state in RocksDB, of which a micro-batch writes the changes, and no batches without data.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
MARK = "__new_url"


def _first_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of each URL in every Arrow batch, so that a hot URL is few rows before it is shuffled.

    Records are numbered as the task reads them, which tells those of one file apart.
    """
    start = 0
    for batch in batches:
        order = pc.sort_indices(batch.select(["__key", "__order"]), sort_keys=[("__key", "ascending"), ("__order", "ascending")])
        keys, kept, last = batch.column("__key").take(order).to_pylist(), [], None
        for key, at in zip(keys, order.to_pylist()):
            if key != last or key.startswith("-"):
                kept.append(at)
            last = key
        first = batch.take(pa.array(kept, pa.int64()))
        texts = [f"{text} {start + at:015d}" for text, at in zip(first.column("__order").to_pylist(), kept)]
        start += batch.num_rows
        yield first.set_column(first.schema.get_field_index("__order"), "__order", pa.array(texts, pa.string()))


def unseen_records(decoded: DataFrame, hours: float = SEEN_FOR_HOURS) -> DataFrame:
    """A stream of decoded records with one row more for each URL that was not seen in the last ``hours``: its ``MARK`` is true, all but the URL is null.

    In a micro-batch ``of_new_urls`` then takes the records of these URLs. State is one time per URL, kept by the engine and dropped in the batch
    after the time limit; it is part of the query's checkpoint. Start the query with ``start``.
    """
    readable = decoded.filter(F.col("decode_error").isNull())
    keyed = readable.select(F.concat(F.lit("u"), "url").alias("__key"), F.lit("").alias("__order"))
    first = keyed.mapInArrow(_first_of_batch, keyed.schema).select("__key", F.current_timestamp().alias("__at"))
    # A key stays for the delay after the watermark has passed it, which itself is the delay behind: half of the limit each.
    seconds = max(1, round(hours * 1800))
    new = first.withWatermark("__at", f"{seconds} seconds").dropDuplicatesWithinWatermark(["__key"])
    marks = [F.substring("__key", 2, 2**31 - 1) if f.name == "url" else F.lit(None).cast(f.dataType) for f in decoded.schema.fields]
    marks = new.select(*[c.alias(n) for c, n in zip(marks, decoded.columns)], F.lit(True).alias(MARK))
    return decoded.withColumn(MARK, F.lit(False)).unionByName(marks)


def of_new_urls(batch: DataFrame) -> DataFrame:
    """The readable records of a micro-batch of ``unseen_records`` whose URL is new to the query. Reads the batch twice: ``each_batch`` keeps it."""
    readable = batch.filter(~F.col(MARK) & F.col("decode_error").isNull()).drop(MARK)
    return readable.join(batch.filter(MARK).select("url"), "url", "left_semi").select(*readable.columns)


def each_batch(work: Callable[[DataFrame, int], None], spark: SparkSession) -> Callable[[DataFrame, int], None]:
    """``work`` for ``foreachBatch``: the micro-batch is kept while it is worked on, and its queries run as the session ``spark`` runs others.

    Records are numbered as tasks read them (``row``), which tells those of one file apart.
    A stream's own session has adaptive execution off, so that without this every join and write of a batch would have all shuffle partitions.
    """
    key = "spark.sql.adaptive.enabled"
    wanted = spark.conf.get(key)

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(key)
        if "row" not in batch.columns:
            batch = batch.withColumn("row", F.monotonically_increasing_id())
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            conf.set(key, wanted)
            work(batch, batch_id)
        finally:
            conf.set(key, before)
            batch.unpersist()

    return run


def start(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Starts a query with the settings that ``unseen_records`` needs; the session keeps its own for other queries."""
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def fresh_records(decoded: DataFrame, stored: DataFrame) -> DataFrame:
    """Readable records whose URL is not stored, one per URL: the first to arrive, however the stream is cut into batches."""
    readable = decoded.filter(F.col("decode_error").isNull())
    order = [F.col(c).asc() for c in ("arrived", "row") if c in decoded.columns]
    order.append(F.xxhash64("title", "body", "source").asc())
    return first_per_group(new_items(readable, stored), ["url"], order, 1).drop("arrived", "row")


def write_batch(
    decoded: DataFrame, batch_id: int, table: ItemTable, dead_letters: str, analyse: Factory,
    vectorise: Factory, query_id: str = "batch", **options,
) -> None:
    """Works off one micro-batch of decoded records, marked by ``unseen_records`` or not.

    Records that cannot be read go to a dead-letter folder of their own per query and batch, which only the same
    batch run again overwrites. ``each_batch`` keeps the micro-batch while it is worked on; its size is bounded by
    the reader's settings. Its new rows are kept as well, as they are looked at for their keys before they go to the models.
    Without readable records no table is read.
    """
    letters = decoded.filter(F.col("decode_error").isNotNull()).select(
        "source", "payload", F.col("raw_run_id").alias("pipeline_run_id"), "decode_error"
    )
    if not letters.isEmpty():
        letters.write.mode("overwrite").json(f"{dead_letters}/query_id={query_id}/batch_id={batch_id}")
    marked = MARK in decoded.columns
    readable = decoded.filter(F.col(MARK) if marked else F.col("decode_error").isNull())
    if readable.isEmpty():
        return
    unseen = of_new_urls(decoded) if marked else decoded
    items = to_items(fresh_records(unseen, having(table.read(), readable, "url")), F.col("pipeline_run_id"))
    # One row per key as well: URL and title are joined without a separator.
    items = first_per_group(items, ["dedup_key"], [F.col("url").asc()], 1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_items(table, items, analyse, vectorise, items.select("dedup_key"), **options)
    finally:
        items.unpersist()


def start_worker(
    records: DataFrame, table: ItemTable, checkpoint: str, dead_letters: str, analyse: Factory,
    vectorise: Factory, policy: str = "mask", available_now: bool = False, interval: str = "5 seconds",
    seen_for_hours: float = SEEN_FOR_HOURS, **options,
) -> StreamingQuery:
    """Starts working off the stream; ``available_now`` stops after what is there."""

    def work(batch: DataFrame, batch_id: int) -> None:
        here = ItemTable(batch.sparkSession, table.path, table.schema, table.digits)
        # The query's id lives in its checkpoint: a new checkpoint counts its batches from 0 under another id.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        write_batch(batch, batch_id, here, dead_letters, analyse, vectorise, query_id, policy=policy, **options)

    fresh = unseen_records(decode_records(records), seen_for_hours)
    writer = fresh.writeStream.foreachBatch(each_batch(work, records.sparkSession)).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return start(writer.trigger(**trigger), records.sparkSession)


LETTER = "source string, payload string, pipeline_run_id string, decode_error string, query_id string, batch_id long"


def dead_letters_of(spark: SparkSession, dead_letters: str) -> DataFrame:
    """All unreadable records with the reason and the batch they came in."""
    try:
        return spark.read.schema(LETTER).json(dead_letters)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LETTER)


def replay_dead_letters(spark: SparkSession, dead_letters: str, folder: str) -> None:
    """Publishes the unreadable records again, each once, for instance after the decoder was mended.

    Batches already replayed are noted next to the letters, after their records were published; a record that cannot be read again is a
    new letter of its own.
    """
    noted = f"{dead_letters.rstrip('/')}-replayed"
    batches = ["query_id", "batch_id"]
    letters = dead_letters_of(spark, dead_letters)
    done = dead_letters_of(spark, noted).select(*batches)
    waiting = letters.join(done, batches, "left_anti")
    now = waiting.select(*batches).distinct().collect()
    if not now:
        return
    these = spark.createDataFrame([tuple(r) for r in now], "query_id string, batch_id long")
    letters.join(these, batches, "left_semi").select(*S.STREAM_RECORD.names).write.mode("append").json(folder)
    these.write.mode("append").json(noted)

import json
import time

import pyarrow as pa
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.operators.enrich import embed, enrich
from newsledger.operators.items import to_items
from newsledger.operators.pages import entry_bodies
from newsledger.plans.collect import Source
from newsledger.plans.process import process_items
from newsledger.plans.store import retry_failed, run_batch, write_items
from newsledger.sources.item_table import ItemTable
from newsledger.sources.profiles import CENTRAL_BANK, REGULATOR
from newsledger.streaming import ingest


def analyst():
    return lambda texts: [json.dumps({"summary": f"{len(t)}", "importance_score": 3, "tags": ["x", "y"]}) for t in texts]


def vectors():
    return lambda texts: [[float(len(t))] * S.EMBEDDING_DIM for t in texts]


def worker(spark, root, table, checkpoint="checkpoint", **options):
    ingest.start_worker(
        ingest.read_records(spark, f"{root}/records", 1), table, f"{root}/{checkpoint}", f"{root}/dead", analyst, vectors,
        available_now=True, **options,
    ).awaitTermination()


def entries(spark, n, tag="u"):
    rows = [("s", f"t{i}", f"{tag}{i}", f"mail a{i}@example.org body {i}") for i in range(n)]
    return spark.createDataFrame(rows, "source string, title string, url string, body string")


COMPARED = ("source", "title", "summary", "body", "url", "importance", "dedup_key", "is_analyzed", "tags", "embedding")


def shown(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*COMPARED).collect())


def test_stream_equals_batch_and_replays_change_nothing(spark, tmp_path):
    items = to_items(entries(spark, 12))
    ingest.publish(items.repartition(3), f"{tmp_path}/records")
    table = ItemTable(spark, f"{tmp_path}/items")
    worker(spark, tmp_path, table)
    batch = process_items(items, analyst, vectors, "mask", keep=False)
    first = shown(table.read())
    assert first == shown(batch) and len(first) == 12
    worker(spark, tmp_path, table)  # nothing new
    worker(spark, tmp_path, table, checkpoint="second")  # everything again
    assert shown(table.read()) == first
    before = {str(p) for p in (tmp_path / "items").rglob("*.parquet")}
    ingest.publish(to_items(entries(spark, 15)), f"{tmp_path}/records")
    worker(spark, tmp_path, table)
    assert table.read().count() == 15 and before < {str(p) for p in (tmp_path / "items").rglob("*.parquet")}  # appended, not rewritten
    assert table.read().filter(F.col("body").contains("@")).count() == 0


def test_a_batch_without_new_urls_reads_no_table(spark, tmp_path, monkeypatch):
    """Seen URLs are state: later batches of the same query do not look into the table for them."""
    table = ItemTable(spark, f"{tmp_path}/items")
    ingest.publish(to_items(entries(spark, 6)).coalesce(1), f"{tmp_path}/records")
    worker(spark, tmp_path, table)
    assert table.read().count() == 6
    read = []
    rows = ItemTable.rows
    monkeypatch.setattr(ItemTable, "rows", lambda self: read.append(1) or rows(self))
    for _ in range(2):
        ingest.publish(to_items(entries(spark, 6)).coalesce(1), f"{tmp_path}/records")
    broken = spark.createDataFrame([("s", "not json", None)] * 3, S.STREAM_RECORD)
    broken.coalesce(1).write.mode("append").json(f"{tmp_path}/records")
    worker(spark, tmp_path, table)
    assert not read and ingest.dead_letters_of(spark, f"{tmp_path}/dead").count() == 3
    ingest.publish(to_items(entries(spark, 7)).coalesce(1), f"{tmp_path}/records")
    worker(spark, tmp_path, table)
    assert read and table.read().count() == 7


def test_a_hot_url_is_cut_before_the_shuffle():
    rows = [("uhot" if k % 3 else f"u{k}", f"{999 - k:03d}") for k in range(900)] + [("-7", "1")] * 5
    batch = pa.RecordBatch.from_pylist([{"__key": k, "__order": o, "x": n} for n, (k, o) in enumerate(rows)])
    (got,) = ingest._first_of_batch([batch])
    assert got.num_rows == 1 + 300 + 5
    assert [r["x"] for r in got.to_pylist() if r["__key"] == "uhot"] == [899 - (899 % 3 == 0)]


def test_records_with_gaps_and_dead_letters(spark, tmp_path):
    run = "0f0e0d0c-0b0a-4908-8706-050403020100"
    rows = [
        (None, json.dumps({"title": "a", "url": "u1", "body": "b"}), ""),
        ("s", json.dumps({"url": "u2"}), run.upper().replace("-", "")),
        ("s", "not json", None), ("s", "[1]", None), ("s", json.dumps({"url": "u3"}), "no-uuid"),
        ("s", None, None), ("s", json.dumps({"title": "b", "url": "u1", "body": "c"}), None),
    ]
    records = spark.createDataFrame(rows, S.STREAM_RECORD)
    decoded = ingest.decode_records(records).collect()
    assert decoded[0].source == "unknown" and decoded[0].pipeline_run_id is None and decoded[0].decode_error is None
    assert decoded[1].title == "" and decoded[1].body == "" and decoded[1].pipeline_run_id == run
    assert [bool(d.decode_error) for d in decoded] == [False, False, True, True, True, False, False]
    records.coalesce(1).write.json(f"{tmp_path}/records")
    table = ItemTable(spark, f"{tmp_path}/items")
    worker(spark, tmp_path, table)
    assert sorted(r.url for r in table.read().collect()) == ["", "u1", "u2"]
    assert table.read().filter("url = 'u1'").first().title == "a"
    assert ingest.dead_letters_of(spark, f"{tmp_path}/dead").count() == 3
    for _ in range(2):
        ingest.replay_dead_letters(spark, f"{tmp_path}/dead", f"{tmp_path}/again")
        assert spark.read.schema(S.STREAM_RECORD).json(f"{tmp_path}/again").count() == 3
    worker(spark, tmp_path, table, checkpoint="second")
    assert ingest.dead_letters_of(spark, f"{tmp_path}/dead").count() == 6


def test_key_already_stored_under_another_url_is_updated(spark, tmp_path):
    """URL and title are joined without a separator, so 'ab' + 'c' and 'a' + 'bc' share a key."""
    one = spark.createDataFrame([("s", "c", "ab", "first")], "source string, title string, url string, body string")
    two = spark.createDataFrame([("s", "bc", "a", "second")], "source string, title string, url string, body string")
    table = ItemTable(spark, f"{tmp_path}/items")
    ingest.publish(to_items(one), f"{tmp_path}/records")
    worker(spark, tmp_path, table)
    ingest.publish(to_items(two), f"{tmp_path}/records")
    worker(spark, tmp_path, table)
    (row,) = table.read().collect()
    assert (row.title, row.url, row.body) == ("bc", "a", "second")


def test_quarantine_policy_on_a_stream(spark, tmp_path):
    ingest.publish(to_items(entries(spark, 2)), f"{tmp_path}/records")
    table = ItemTable(spark, f"{tmp_path}/items")
    worker(spark, tmp_path, table, policy="quarantine")
    rows = table.read().collect()
    assert {r.importance for r in rows} == {10} and not any(r.is_analyzed for r in rows)


def test_records_from_a_log(spark):
    log = spark.createDataFrame(
        [(bytearray(json.dumps({"source": "s", "payload": "{}", "pipeline_run_id": ""}).encode()),), (None,)], "value binary"
    )
    first, second = ingest.records_from_log(log).collect()
    assert (first.source, first.payload) == ("s", "{}") and second.source is None


def test_batch_job_twice(spark, tmp_path):
    """Both built-in sources from list page to stored row; a second run adds nothing."""
    pages = "page_id int, url string, html string"

    def source(profile, host, prefix, link, container):
        listing = "".join(f'<a title="{link} {i}" href="{link}{i}">x</a>' for i in range(3))
        articles = [(i, f"{host}{prefix}{link}{i}", f"<div {container}>text {i} {link}</div>") for i in range(3)]
        return Source(
            profile, spark.createDataFrame([(1, f"{host}/list", listing)], pages), spark.createDataFrame(articles, pages)
        )

    sources = [
        source(REGULATOR, "https://www.fsc.gov.tw", "/ch/", "home.jsp?id=2&n=", "id='content'"),
        source(CENTRAL_BANK, "https://www.cbc.gov.tw", "/tw/", "cp-302-", "class='cp'"),
    ]
    table = ItemTable(spark, f"{tmp_path}/items")
    run = run_batch(table, sources, analyst, vectors, limit=2)
    rows = table.read().orderBy("url").collect()
    assert len(rows) == 4 and {r.pipeline_run_id for r in rows} == {run} and all(r.is_analyzed for r in rows)
    assert [r.body for r in rows] == ["text 0 cp-302-", "text 1 cp-302-", "text 0 home.jsp?id=2&n=", "text 1 home.jsp?id=2&n="]
    assert {r.source for r in rows} == {"金管會", "中央銀行"}
    run_batch(table, sources, analyst, vectors, limit=2)
    assert table.read().count() == 4
    run_batch(table, sources, analyst, vectors)
    assert table.read().count() == 6


def test_one_stored_key_does_not_change_other_rows(spark, tmp_path):
    """A new row is stored alike whether or not another row of the increment is stored already."""
    roles = spark.createDataFrame([("r9", "法遵長")], "role_id string, role_name string")

    def answers():
        return lambda texts: [json.dumps({"summary": "s", "target_roles": ["法遵長"]}) for _ in texts]

    got = {}
    for name, first in (("alone", 0), ("clash", 1)):
        table = ItemTable(spark, f"{tmp_path}/{name}")
        if first:
            write_items(table, to_items(entries(spark, 1)), answers, vectors, roles=roles, policy="mask")
        write_items(table, to_items(entries(spark, 2)), answers, vectors, roles=roles, policy="mask")
        write_items(table, to_items(entries(spark, 2).union(entries(spark, 2))), answers, vectors, roles=roles, policy="mask")
        rows = table.read().collect()
        assert len(rows) == 2
        got[name] = next(tuple(str(r[c]) for c in (*COMPARED, "target_roles")) for r in rows if r.url == "u1")
    assert got["alone"] == got["clash"] and "r9" in got["alone"][-1]


def test_failed_answers_are_stored_and_retried(spark, tmp_path):
    def broken():
        return lambda texts: [{"no": "text"} if "body 1" in t else json.dumps({"summary": "fine"}) for t in texts]

    def odd_vectors():
        return lambda texts: [[[1.0]] if "t2" in t else [1.0] * S.EMBEDDING_DIM for t in texts]

    table = ItemTable(spark, f"{tmp_path}/items")
    write_items(table, to_items(entries(spark, 3)), broken, odd_vectors, policy="mask")
    failed = {r.url: (r.analysis_error, r.embedding_error) for r in table.failed().collect()}
    assert set(failed) == {"u1", "u2"} and "dict" in failed["u1"][0] and "list" in failed["u2"][1]
    retry_failed(table, analyst, vectors, policy="mask")
    assert table.failed().count() == 0 and table.read().count() == 3


def test_first_record_wins_however_batches_are_cut(spark, tmp_path):
    for k in range(4):
        rows = [("s", json.dumps({"title": f"t{k}", "url": f"u{n}", "body": "b"}), None) for n in (k, k + 1)]
        spark.createDataFrame(rows, S.STREAM_RECORD).coalesce(1).write.mode("append").json(f"{tmp_path}/records")
        time.sleep(1.1)
    want = {"u0": "t0", "u1": "t0", "u2": "t1", "u3": "t2", "u4": "t3"}
    for files in (1, 4, None):
        table = ItemTable(spark, f"{tmp_path}/items-{files}")
        ingest.start_worker(
            ingest.read_records(spark, f"{tmp_path}/records", files), table, f"{tmp_path}/checkpoint-{files}", f"{tmp_path}/dead", analyst, vectors,
            available_now=True,
        ).awaitTermination()
        assert {r.url: r.title for r in table.read().collect()} == want


def test_answers_of_wrong_types_fail_their_row_only(spark):
    answers = {"a": "{}", "b": {"x": 1}, "c": 5, "d": ["{}"], "e": None}
    lists = {"a": [1.0] * 4, "b": {"x": 1}, "c": 5, "d": [[1.0]], "e": [1.0] * 3, "f": "text"}
    frame = spark.createDataFrame([(k,) for k in lists], "t string")
    done = enrich(frame, "t", lambda: lambda texts: [answers.get(t, "{}") for t in texts]).collect()
    assert {r.t: bool(r.analysis_error) for r in done} == {"a": False, "b": True, "c": True, "d": True, "e": True, "f": False}
    got = {r.t: (r.embedding_error, r.embedding) for r in embed(frame, "t", lambda: lambda texts: [lists[t] for t in texts], dim=4).collect()}
    assert got["a"][0] is None and all(got[k][0] for k in "bcdf") and all(len(v[1]) == 4 for v in got.values())


def test_the_last_fetch_of_a_page_counts(spark):
    pages = spark.createDataFrame(
        [(1, "https://www.cbc.gov.tw/tw/a", "<div class='cp'>one</div>"), (2, "https://www.cbc.gov.tw/tw/a", "<div class='cp'>two</div>")],
        "page_id int, url string, html string",
    )
    wanted = spark.createDataFrame([("https://www.cbc.gov.tw/tw/a",), ("https://www.cbc.gov.tw/tw/b",)], "url string")
    assert sorted(r.body for r in entry_bodies(wanted, pages, CENTRAL_BANK).collect()) == ["", "two"]


def test_seen_urls_are_kept_by_the_engine_and_batches_adapt(spark, tmp_path):
    """No row passes Python for the state, which gets keys only; what a batch runs adapts as the session's other queries do."""
    rows = [("s", json.dumps({"title": f"t{n}", "url": "hot" if n % 2 else f"u{n}", "body": "b"}), None) for n in range(40)] + [("s", "broken", None)] * 3
    spark.createDataFrame(rows, S.STREAM_RECORD).coalesce(1).write.json(f"{tmp_path}/records")
    seen = []

    def work(batch, _):
        fresh = ingest.of_new_urls(batch)
        seen.append((batch.sparkSession.conf.get("spark.sql.adaptive.enabled"), batch.filter("decode_error is not null").count(), fresh.count()))
        none = batch.sparkSession.createDataFrame([], "url string")
        ingest.fresh_records(fresh, none).select("url", "title").write.mode("append").parquet(f"{tmp_path}/fresh")

    decoded = ingest.decode_records(ingest.read_records(spark, f"{tmp_path}/records"))
    unseen = ingest.unseen_records(decoded)
    writer = unseen.writeStream.foreachBatch(ingest.each_batch(work, spark)).option("checkpointLocation", f"{tmp_path}/checkpoint")
    query = ingest.start(writer.trigger(availableNow=True), spark)
    query.awaitTermination()
    assert seen == [("true", 3, 40)]
    plan = query._jsq.explainInternal(True)
    assert "DeduplicateWithinWatermark" in plan and "TransformWithState" not in plan
    titles = {r.url: r.title for r in spark.read.parquet(f"{tmp_path}/fresh").collect()}
    assert len(titles) == 21 and titles["hot"] == "t1"  # the first of its file

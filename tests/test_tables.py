import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.operators import roles, search, stored
from newsledger.sources.item_table import ItemTable
from tests.conftest import plan_of

OLD = [("k1", "t1", 1, "b1"), ("k2", "t2", 2, "b2")]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(OLD, "dedup_key string, title string, importance smallint, body string")


def test_upsert_overwrites_only_given_columns(spark, table):
    new = spark.createDataFrame(
        [("k2", None, 7, 1), ("k3", "t3", 8, 1), ("k3", "t3b", 9, 2)],
        "dedup_key string, title string, importance smallint, seq int",
    )
    got = stored.upsert(table, new, order=["seq"], defaults={"body": F.lit("none")})
    assert got.schema == table.schema or [f.name for f in got.schema] == table.columns
    rows = {r.dedup_key: tuple(r)[1:] for r in got.collect()}
    assert rows == {"k1": ("t1", 1, "b1"), "k2": (None, 7, "b2"), "k3": ("t3b", 9, "none")}
    again = stored.upsert(got, new, order=["seq"], defaults={"body": F.lit("none")})
    assert {r.dedup_key: tuple(r)[1:] for r in again.collect()} == rows


def test_upsert_of_items_takes_the_column_defaults(spark):
    empty = spark.createDataFrame([], S.ITEMS)
    new = spark.createDataFrame([("k", "s", "t")], "dedup_key string, source string, title string")
    row = stored.upsert_items(empty, new).first()
    assert (row.importance, row.is_analyzed, row.sentiment_score, row.tags) == (5, False, 0.0, [])
    assert row.id and row.created_at and row.embedding is None


def test_upsert_with_repeated_keys_keeps_one_row(spark, table):
    new = spark.createDataFrame([("k2", "x"), ("k2", "y"), ("k9", "p"), ("k9", "q")], "dedup_key string, title string")
    picks = set()
    for parts in (1, 2, 4):
        rows = stored.upsert(table, new.repartition(parts)).collect()
        assert sorted(r.dedup_key for r in rows) == ["k1", "k2", "k9"]
        picks.add(tuple(sorted((r.dedup_key, r.title) for r in rows)))
    assert len(picks) == 1
    limited = {r.dedup_key: r.title for r in stored.upsert(table, new, update=["body"]).collect()}
    assert limited["k2"] == "t2" and limited["k9"] in "pq"


def test_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "id").repartition(4)
    last = stored.last_per_key(hot, "k", ["id"])
    assert last.count() == 2001 and last.filter("k = 'hot'").first().id == 2997
    assert plan_of(last).count("WindowGroupLimit") >= 2


def test_urls(spark):
    old = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "url string")
    new = spark.createDataFrame([("b", 1), ("c", 2), ("c", 3), (None, 4)], "url string, n int")
    assert [r.n for r in stored.new_items(new, old).orderBy("n").collect()] == [2, 3, 4]
    assert [r.url for r in stored.existing_urls(new, old).collect()] == ["b"]
    assert [r.is_stored for r in stored.url_exists(new, old).orderBy("n").collect()] == [True, False, False, False]
    assert stored.existing_urls(new.limit(0), old).count() == 0
    keys = stored.insert_if_absent(new.filter("n > 1 and n < 4"), old, "url").collect()
    assert [r.url for r in keys] == ["c"]


def test_seed_roles(spark):
    have = spark.createDataFrame([("1", "法遵長", "x", None)], S.ROLES)
    added = roles.seed_roles(spark, have).collect()
    assert len(added) == 4 and "法遵長" not in {r.role_name for r in added}
    assert roles.seed_roles(spark).count() == 5
    assert {r.role_name: r.role_id for r in roles.role_map(have).collect()} == {"法遵長": "1"}


def test_role_filter(spark):
    have = spark.createDataFrame([("1", "a"), ("2", "b")], "role_id string, role_name string")
    rows = spark.createDataFrame([(1, []), (2, None), (3, ["1"]), (4, ["2", "1"]), (5, ["2"])], "n int, target_roles array<string>")

    def seen(name, **kw):
        return [r.n for r in roles.role_filter(rows, have, name, **kw).orderBy("n").collect()]

    assert seen("a") == [1, 2, 3, 4] and seen("b") == [1, 2, 4, 5]
    assert seen("nobody") == [1, 2, 3, 4, 5] and seen("nobody", strict=True) == [1, 2]
    assert seen(None) == seen("") == [1, 2, 3, 4, 5]
    assert "Cartesian" not in plan_of(roles.role_filter(rows, have, "a"))


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_roles_to_ids(spark, broadcast):
    """Repeated role names, items without a key and repeated items: the same rows however the join is done."""
    have = spark.createDataFrame([("2", "a"), ("1", "b"), ("9", "a"), ("5", None)], "role_id string, role_name string")
    data = [("x", ["a", "b", "a", "?"]), ("y", []), ("z", None), (None, ["a"]), (None, ["a"]), ("w", [None, "b"])]
    rows = spark.createDataFrame(data, "dedup_key string, role_names array<string>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = sorted((r.dedup_key or "", r.target_roles) for r in roles.roles_to_ids(rows, have).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [("", ["2"]), ("", ["2"]), ("w", ["1"]), ("x", ["1", "2"]), ("y", []), ("z", [])]


def test_preferences(spark):
    at = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([("a", {"x": "1", "y": "2"}, at), ("b", {"x": "3"}, at)], S.PREFERENCES)
    new = spark.createDataFrame(
        [("a", {"y": "8"}, 1), ("a", {"y": "9", "z": None}, 2), ("c", {"q": "1"}, 1)],
        "role_name string, preferences map<string,string>, seq int",
    )
    done = roles.preferences_upsert(old, new, F.timestamp_seconds(F.lit(1800000000)), ["seq"])
    rows = {r.role_name: (r.preferences, r.updated_at == at) for r in done.collect()}
    assert rows == {
        "a": ({"x": "1", "y": "9", "z": None}, False), "b": ({"x": "3"}, True), "c": ({"q": "1"}, False),
    }
    assert roles.preferences_get(done, "b").first().preferences == {"x": "3"}
    assert roles.preferences_get(done, "nobody").count() == 0


def test_query(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [
        ("k1", "資安 One", "c", day, ["1"]), ("k2", "資安 two", "c", None, []), ("k3", "one%x", "d", day, []),
        ("k4", "ONE", "c", dt.datetime(2024, 2, 1), []), ("k0", "資安 three", "c", day, []),
    ]
    df = spark.createDataFrame(rows, "dedup_key string, title string, category string, published_at timestamp, target_roles array<string>")
    df = df.withColumns({"summary": F.lit("s"), "importance": F.lit(1), "url": F.col("dedup_key")})
    have = spark.createDataFrame([("2", "r")], "role_id string, role_name string")

    def urls(**kw):
        return [r.url for r in search.intel_query(df, **kw).collect()]

    assert urls() == ["k2", "k4", "k0", "k1", "k3"]  # no time first, newest next, ties by key
    assert urls(query="one") == ["k4", "k1", "k3"] and urls(query="o_e", category="d") == ["k3"]
    assert urls(query="\\%x") == ["k3"] and urls(query="\\o\\ne") == ["k4", "k1", "k3"] and urls(query="x\\") == []
    assert urls(query="", category="") == urls() and urls(query="資安", limit=2) == ["k2", "k0"]
    assert urls(query="資安", role_name="r", roles=have) == ["k2", "k0"]
    assert urls(limit=4, role_name="r", roles=have) == ["k2", "k4", "k0", "k3"]
    assert urls(limit=4, role_name="r", roles=have, role_filter="after_limit") == ["k2", "k4", "k0"]
    assert search.intel_query(df).columns == list(search.QUERY_COLUMNS)
    assert "TakeOrderedAndProject" in plan_of(search.intel_query(df, "one"))


def test_item_table(spark, tmp_path):
    table = ItemTable(spark, f"{tmp_path}/items")
    assert table.read().count() == 0
    row = spark.createDataFrame([("k1", "s", "t")], "dedup_key string, source string, title string")
    table.append(row)
    table.append(row.withColumn("dedup_key", F.lit("k2")))
    assert table.read().count() == 2
    changed = row.withColumn("title", F.lit("new"))
    table.merge(changed, row.select("dedup_key"), stored.upsert_items)
    assert {r.dedup_key: r.title for r in table.read().collect()} == {"k1": "new", "k2": "t"}
    table.merge(changed, row.select("dedup_key"), stored.upsert_items)  # run again
    assert table.read().count() == 2
    table.append(row.withColumn("dedup_key", F.lit(None).cast("string")))
    assert table.read().count() == 3 and [f.name for f in table.read().schema] == [f.name for f in S.ITEMS]


def files(folder):
    return {str(p) for p in folder.rglob("*.parquet")}


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    table = ItemTable(spark, f"{tmp_path}/items", digits=1)
    table.append(spark.range(200).selectExpr("concat('k', id) dedup_key", "'s' source", "'t' title"))
    before = files(tmp_path / "items")
    change = spark.createDataFrame([("k5", "s", "new"), ("x1", "s", "x")], "dedup_key string, source string, title string")
    table.merge(change, change.filter("dedup_key = 'k5'"), stored.upsert_items)
    assert table.read().count() == 201 and table.read().filter("title = 'new'").count() == 1
    gone = before - files(tmp_path / "items")
    assert len({p.split("part=")[1][0] for p in before}) == 16 and len({p.split("part=")[1][0] for p in gone}) == 1
    # A table keeps its partitions, whatever later jobs would choose.
    ItemTable(spark, f"{tmp_path}/items", digits=2).append(change.withColumn("dedup_key", F.lit("k900")))
    assert {len(p.split("part=")[1].split("/")[0]) for p in files(tmp_path / "items")} == {1}


def rows_scanned(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_some_keys_are_looked_up_in_few_row_groups(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("sha2(cast(id as string), 256) dedup_key", "concat('https://news.example/', md5(cast(id as string))) url", "'s' source", "'t' title")
    table = ItemTable(spark, f"{tmp_path}/items")
    spark.conf.set("parquet.block.size", str(1 << 16))
    spark._jsc.hadoopConfiguration().set("parquet.block.size", str(1 << 16))
    try:
        table.append(rows)
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
    for key in ("url", "dedup_key"):
        some = table.read().select(key).limit(2)
        others = spark.range(1000).select(F.concat(F.lit("no such key "), "id").alias(key))
        assert rows_scanned(stored.having(table.read(), others, key).select(key)) == 0
        found = stored.having(table.read(), some.unionByName(others), key).select(key)
        assert 2 <= rows_scanned(found) < 20_000 and found.count() == 2
    # Too many keys, or too long ones: the table as it is. No keys: nothing.
    many = spark.range(stored.FEW_KEYS + 1).select(F.concat(F.lit("u"), "id").alias("url"))
    long = spark.range(1).select(F.repeat(F.lit("x"), stored.LONGEST_KEY + 1).alias("url"))
    none = spark.range(1).select(F.lit(None).cast("string").alias("url"))
    assert [stored.having(table.read(), k, "url").count() for k in (many, long, none)] == [40_000, 40_000, 0]


def test_insert_takes_the_first_in_order(spark):
    new = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "dedup_key string, seq int")
    old = spark.createDataFrame([("b",)], "dedup_key string")
    assert [tuple(r) for r in stored.insert_if_absent(new, old, order=["seq"]).collect()] == [("a", 1)]
    picks = {tuple(stored.insert_if_absent(new.repartition(n), old).first()) for n in (1, 2, 5)}
    assert len(picks) == 1


def test_hot_keys_without_any_broadcast(spark):
    """A third of all rows share one key; every join is a shuffled one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        key = "if(id % 3 = 0, 'hot', concat('u', id))"
        new = spark.range(900).selectExpr(f"{key} url", f"{key} dedup_key", "id seq", "cast(id as string) title").repartition(4)
        old = spark.range(450, 1350).selectExpr(f"{key} url", f"{key} dedup_key", "'old' title", "id kept")
        fresh = stored.new_items(new, old)
        assert fresh.count() == 300 and fresh.filter("url = 'hot'").count() == 0
        assert stored.existing_urls(new, old).count() == 301
        flags = stored.url_exists(new, old)
        assert flags.count() == 900 and flags.filter("is_stored").count() == 600
        assert stored.insert_if_absent(new, old.filter("url <> 'hot'")).count() == 301
        unique = stored.last_per_key(old, "dedup_key", ["kept"])
        done = stored.upsert(unique, new, order=["seq"])
        assert done.count() == 901 and done.select("dedup_key").distinct().count() == 901
        hot = done.filter("dedup_key = 'hot'").first()
        assert hot.title == "897" and hot.kept == 1347
        assert done.filter("title = 'old'").count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

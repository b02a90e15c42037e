import itertools

import pytest
from pyspark.sql import functions as F

from newsledger.operators.search import intel_query, title_ilike
from newsledger.sources.title_index import TitleIndex, bigrams, literal_pieces

TITLES = [
    "Interest rates rise", "RATES of interest", "利率調升公告", "央行 利率 決議", "100% sure", "a_b under", "axb", "ΟΔΟΣ ΣΑΜΟΣ", "İstanbul", "x", "", None,
    "😀😁 faces", "back\\slash", "two\nlines", "Interest rates rise",
]
QUERIES = [
    "rate", "RATES", "利率", "利%決", "率調升", "0\\%", "a\\_b", "a_b", "%", "_", "x", "é", "οδος", "ΣΑΜΟΣ", "ΔΟΣ Σ", "i̇st", "İST", "😀😁", "\\\\", "k\\\\s", "o\nl", "rest r", "nothing here", "e%e%e",
    "\\", "interest rates rise and more",
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(None if i == 1 else f"k{i % 15}", t) for i, t in enumerate(TITLES)], "dedup_key string, title string")


@pytest.fixture(scope="module")
def index(spark, items, tmp_path_factory):
    index = TitleIndex(spark, str(tmp_path_factory.mktemp("titles")))
    index.add(items.limit(9))
    index.add(items)  # again, with the rest
    return index


def rows(found):
    return sorted(map(repr, found.collect()))


def test_same_rows_with_the_index(items, index):
    for query in QUERIES:
        assert rows(title_ilike(items, query, index)) == rows(title_ilike(items, query)), query


def test_bigrams(spark):
    df = spark.createDataFrame([("AbAb",), ("利率升",), ("😀😁x",), ("a",), ("",), (None,)], "t string")
    assert [r.b for r in df.select(bigrams(F.col("t")).alias("b")).collect()] == [["ab", "ba"], ["利率", "率升"], ["😀😁", "😁x"], [], [], []]
    assert literal_pieces("%ab\\%c_d\\\\%%") == ["ab%c", "d\\"]


def test_changed_titles_are_checked(spark, items, index):
    changed = items.withColumn("title", F.when(F.col("dedup_key") == "k0", "Interest falls").otherwise(F.col("title")))
    index.add(changed.filter("dedup_key = 'k0'"))
    for query in ("rates", "falls"):
        assert rows(title_ilike(changed, query, index)) == rows(title_ilike(changed, query))


def test_a_query_reads_only_its_grams(spark, tmp_path):
    words = ["".join(p) for p in itertools.product("abcdefgh", repeat=4)]
    many = spark.createDataFrame([(str(i), w) for i, w in enumerate(words)], "dedup_key string, title string")
    index = TitleIndex(spark, str(tmp_path))
    index.add(many)
    assert index.candidates("%abcd%").count() == 1
    scan = index.candidates("%abcd%")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(gram, [ab,bc,cd])]" in scan and "CartesianProduct" not in scan
    assert index.candidates("%a%") is None and index.candidates("%zz%").count() == 0


def test_intel_query_with_the_index(spark, items, index):
    whole = items.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("summary", "string"), ("importance", "short"), ("category", "string"), ("published_at", "timestamp"), ("url", "string"))])
    assert rows(intel_query(whole, "rates", index=index)) == rows(intel_query(whole, "rates"))

from urllib.parse import urlparse

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsledger.functions.text import WHITESPACE
from newsledger.functions.urls import absolutize, host_of, is_allowed
from newsledger.operators import items, pages
from newsledger.plans.collect import Source, collect_items
from newsledger.sources import html as html_source
from newsledger.sources.pages import pages_source
from newsledger.sources.profiles import CENTRAL_BANK, REGULATOR, PageProfile
from tests.conftest import plan_of


def page_table(spark, *rows):
    return spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(rows)], "page_id int, url string, html string")


def links(spark, profile, *rows):
    found = pages.extract_links(page_table(spark, *rows), profile).orderBy("page_id", "pos").collect()
    return [(r.page_id, r.pos, r.title, r.url) for r in found]


BASE = "https://www.fsc.gov.tw/ch/"


def test_regulator_links(spark):
    html = """<a title="outside" href="home.jsp?id=2&x">o</a><DIV id=content>
      <a title=" First " href=" home.jsp?id=2&amp;a=1 ">x</a>
      <a href="home.jsp?id=2&b">no title</a>
      <a title="網站導覽" href="home.jsp?id=2&c">nav</a>
      <a title="no marker" href="home.jsp?id=3">x</a>
      <a title="no id" href="parentpath=0,2">x</a>
      <a title="" href="home.jsp?id=17&d">empty title counts</a>
      <a title="Again" href="home.jsp?id=2&amp;a=1">x</a>
      <a title="far" href="https://evil.example.org/?id=2&">x</a>
      <a title="abs" href="https://www.fsc.gov.tw/ch/home.jsp?id=2&amp;a=1">same as the first</a>
      <a title="abs2" href="http://www.fsc.gov.tw/?id=9&parentpath=0,2">x</a>
      <a title="" href="">x</a></div><div class="page_content"><a title="later" href="?id=2&z">x</a></div>"""
    assert links(spark, REGULATOR, html) == [
        (0, 0, "First", BASE + "home.jsp?id=2&a=1"),
        (0, 4, "", BASE + "home.jsp?id=17&d"),
        (0, 8, "abs2", "http://www.fsc.gov.tw/?id=9&parentpath=0,2"),
    ]


def test_area_falls_back_by_class_and_to_the_page(spark):
    by_class = '<a title="a" href="?id=2&1">x</a><div class="x page_content"><a title="b" href="?id=2&2">x</a></div>'
    anywhere = '<a title="a" href="?id=2&1">x</a><p><a title="b" href="?id=2&2">x</a>'
    found = links(spark, REGULATOR, by_class, anywhere, "", "no links")
    assert [(f[0], f[2]) for f in found] == [(0, "b"), (1, "a"), (1, "b")]


def test_central_bank_links_have_no_guard(spark):
    html = """<div class="list"><a title="English" href="cp-302-1.html">x</a>
      <a title="far" href="https://other.example.org/cp-302-2.html">x</a><a title="z" href="lp-302-1.html">x</a></div>"""
    assert links(spark, CENTRAL_BANK, html) == [
        (0, 0, "English", "https://www.cbc.gov.tw/tw/cp-302-1.html"),
        (0, 1, "far", "https://other.example.org/cp-302-2.html"),
    ]


def test_first_by_url_in_rows_equals_first_by_url_in_the_page(spark):
    html = "".join(f'<a title="t{i}" href="home.jsp?id=2&n={i * 7 % 5}">x</a>' for i in range(40))
    raw = page_table(spark, html, html[:200], "")
    in_rows = pages.first_by_url(pages.link_rows(pages.read_pages(raw, REGULATOR), REGULATOR))
    in_page = pages.extract_links(raw, REGULATOR)
    assert sorted(map(tuple, in_rows.collect())) == sorted(map(tuple, in_page.collect()))
    assert in_page.filter("page_id = 0").count() == 5


def bodies(spark, profile, *rows):
    found = pages.extract_text(page_table(spark, *rows), profile).orderBy("page_id").collect()
    return [r.body for r in found]


def test_article_text(spark):
    block = """<div id="content">outer<div class="a content_block"> One &amp; two <br>three<script>var s="</p>";</script>
      <style>p{}</style><p>four<!-- hidden -->five<nav>menu</nav><p>  six　</div>tail</div>"""
    assert bodies(spark, REGULATOR, block) == ["One & two\nthree\nfour\nfive\nmenu\nsix"]
    no_block = '<div id="content">a<div>b</div></div>'
    by_class = '<p>x</p><div class="page_content">c<span>d'
    assert bodies(spark, REGULATOR, no_block, by_class, "<p>none</p>", "", "<div id=contents>x</div>") == [
        "a\nb", "c\nd", "", "", "",
    ]
    bank = '<nav>n</nav><section class="cp">t1<nav>menu<b>x</b></nav><b>t2</b></section><div id="content">no</div>'
    assert bodies(spark, CENTRAL_BANK, bank, '<div class="cp">d</div>', '<div id="content">c</div>') == [
        "t1\nt2", "d", "c",
    ]


def test_broken_markup(spark):
    rows = [
        '<div id="content">a</b></i>b<p>c<p>d</div>after',
        '<div id="content"/>text after a self-closed container',
        '<div id="content">x &lt; y &copy; &nope; &#65; &amp<b>z</b> 1 < 2</div>',
        '<div id="content"><![CDATA[raw]]>t<ruby>漢<rt>han</rt></ruby><template>q</template></div>',
        '<div id="content" id="other">second id wins</div>',
    ]
    assert bodies(spark, REGULATOR, *rows) == [
        "a\nb\nc\nd", "", "x < y © &nope A &\nz\n1 < 2", "raw\nt\n漢", "",
    ]


def test_pages_are_parsed_once(spark):
    df = pages.extract_links(page_table(spark, "<a title=x href='?id=2&'>"), REGULATOR)
    assert plan_of(df).count("ArrowEvalPython") == 1 and "Exchange" not in plan_of(df)


def test_whitespace_equals_python():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


URLS = [
    "https://www.fsc.gov.tw/a", "http://www.fsc.gov.tw", "HTTPS://WWW.FSC.GOV.TW/x", "ftp://www.fsc.gov.tw/",
    "https://www.fsc.gov.tw:8443/a", "https://user:pw@www.fsc.gov.tw/", "https://www.fsc.gov.tw@evil.org/",
    "https://evil.org/www.fsc.gov.tw", "https://www.fsc.gov.tw.evil.org", "//www.fsc.gov.tw/", "www.fsc.gov.tw",
    "", "http://", "http://127.0.0.1/", "http://[::1]/", "http://[www.fsc.gov.tw]/", " https://www.fsc.gov.tw/lead",
    "https://www.fsc.gov.tw /blank", "https://www.fsc.gov.tw?x=1", "https://www.fsc.gov.tw#f", "https:/www.fsc.gov.tw/",
    "https://www.fsc.gov.tw\\@evil.org/", "ht\ntps://www.fsc.gov.tw/", "https://www.fsc.gov.tw:x/", "javascript:alert(1)",
    "https://a@b@www.fsc.gov.tw/", "https://www。fsc.gov.tw/", "https://x℀y@www.fsc.gov.tw/", "https:///www.fsc.gov.tw",
    "https://www.fsc.gov.tw./", "https://WWW.fsc.gov.tw\t/", None,
]


def test_url_guard_equals_the_url_parser(spark):
    def expected(url):
        try:
            parsed = urlparse(url or "")
            return parsed.scheme in ("http", "https") and parsed.hostname == "www.fsc.gov.tw"
        except ValueError:
            return False

    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    rows = df.select("url", is_allowed(F.col("url"), ("www.fsc.gov.tw",)).alias("ok"), host_of(F.col("url")).alias("h"))
    for row in rows.collect():
        assert row.ok == expected(row.url), row


def test_absolutize_and_redirects(spark):
    df = spark.createDataFrame([("http://a/x",), ("b?id=1",), ("httpx",)], "href string")
    assert [r.u for r in df.select(absolutize(F.col("href"), "https://h", "/ch/").alias("u")).collect()] == [
        "http://a/x", "https://h/ch/b?id=1", "httpx",
    ]
    moved = spark.createDataFrame(
        [("https://ok.org/1", None), ("https://ok.org/2", "https://ok.org/3"), ("https://ok.org/4", "http://10.0.0.1/"),
         ("http://no.org", "https://ok.org")],
        "url string, final_url string",
    )
    kept = [r.url for r in pages.redirect_guard(moved, ("ok.org",)).collect()]
    assert kept == ["https://ok.org/1", "https://ok.org/2"]
    assert pages.redirect_guard(moved.drop("final_url"), ("ok.org",)).count() == 3


def test_limit_is_cut_below_the_shuffle(spark):
    rows = [("hot", p, i) for p in range(40) for i in range(5)] + [("cold", 1, 0)]
    df = spark.createDataFrame(rows, "source string, page_id int, pos int").selectExpr("*", "concat(page_id, '-', pos) url").repartition(4)
    kept = pages.limit_per_source(df, 7)
    assert {(r.page_id, r.pos) for r in kept.filter("source = 'hot'").collect()} == {
        (0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0), (1, 1),
    }
    assert kept.filter("source = 'cold'").count() == 1
    assert plan_of(kept).count("WindowGroupLimit") >= 2
    # a URL listed again counts once, where it comes first
    again = df.union(df.selectExpr("source", "page_id + 100", "pos", "url"))
    assert sorted(tuple(r) for r in pages.limit_per_source(again, 7).collect()) == sorted(tuple(r) for r in kept.collect())
    many = spark.range(5000).selectExpr("'s' source", "cast(5000 - id as int) page_id", "0 pos", "cast(id as string) url").repartition(4)
    big = pages.limit_per_source(many, 1500)
    assert big.count() == 1500 and big.agg(F.max("page_id")).first()[0] == 1500


def test_collecting(spark):
    profile = PageProfile(**{**REGULATOR.__dict__})
    listing = spark.createDataFrame(
        [(1, "https://www.fsc.gov.tw/list", "".join(f'<a title="t{i}" href="home.jsp?id=2&n={i}">x</a>' for i in range(5)))],
        "page_id int, url string, html string",
    )
    articles = spark.createDataFrame(
        [(f"{BASE}home.jsp?id=2&n={i}", f'<div id="content">body {i}</div>') for i in range(4)], "url string, html string"
    )
    stored = spark.createDataFrame([(f"{BASE}home.jsp?id=2&n=1",)], "url string")
    rows = collect_items([Source(profile, listing, articles)], stored, "run", limit=10).orderBy("title").collect()
    assert [(r.title, r.body) for r in rows] == [("t0", "body 0"), ("t2", "body 2"), ("t3", "body 3"), ("t4", "")]
    assert {r.source for r in rows} == {"金管會"} and {r.pipeline_run_id for r in rows} == {"run"}
    assert collect_items([Source(profile, listing, articles)] * 2, stored, limit=2).count() == 2


def test_items_and_records(spark):
    entries = spark.createDataFrame([("s", "題", "http://u", "字" * 601), ("s", None, None, "")], "source string, title string, url string, body string")
    made = items.to_items(entries, None, F.timestamp_micros(F.lit(1704067200123456)))
    long, bare = made.orderBy(F.desc("body")).collect()
    assert long.summary == "字" * 600 and long.importance == 5 and long.tags == [] and long.category == "scrape"
    assert bare.summary == "" and bare.is_analyzed is False
    import hashlib

    assert long.dedup_key == hashlib.sha256("http://u題".encode()).hexdigest()
    assert bare.dedup_key == hashlib.sha256(b"").hexdigest()
    record = items.to_record(made).orderBy(F.desc("body")).first()
    assert len(record) == 17 and record.published_at == "2024-01-01T00:00:00.123456+00:00"
    assert record.pipeline_run_id is None
    assert "target_roles" not in items.safe_columns(made).columns
    assert items.union_sources(made, made).count() == 4


def test_pages_source_formats(spark, tmp_path):
    df = page_table(spark, "<p>one\n</p>", "two")
    for kind in ("parquet", "orc", "json"):
        df.write.format(kind).save(f"{tmp_path}/{kind}")
        read = pages_source(spark, f"{tmp_path}/{kind}", kind)
        assert sorted(tuple(r) for r in read.select("page_id", "html").collect()) == [(0, "<p>one\n</p>"), (1, "two")]
    df.drop("html").write.parquet(f"{tmp_path}/bad")
    with pytest.raises(ValueError):
        pages_source(spark, f"{tmp_path}/bad")


def test_pages_go_back_in_bounded_pieces():
    """However many pages Spark sends at once, few of them are Python objects at a time."""
    html = ["<div id='content'><a title='t' href='/a'>x</a> text %d</div>" % i for i in range(1000)] + [None, "x" * 3_000_000, "y" * 3_000_000]
    pieces = list(html_source._read_pieces(pa.array(html), REGULATOR))
    assert max(map(len, pieces)) <= 256 and len(pieces) >= 4
    got = [row for piece in pieces for row in piece.to_pylist()]
    assert [(r["links"], r["body"], r["parse_error"]) for r in got] == [html_source._read(h, REGULATOR) for h in html]

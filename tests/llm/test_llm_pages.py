import html
import re

from newsledger.llm import templates

SMALL = "/root/testdata/sf0.01"


def test_blocks_and_what_is_left_out():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header>Site</header>
    <nav><ul><li>menu<li>menu</ul></nav><script>var t="</p><article>no</article>";</script>
    <article class="post"><header><h1>A &amp; B&#33;</h1></header><p>one <b>bold</b>
    word<p>two<br>lines &lt;x&gt;<div class="ad">AD</div><!-- <p>hidden</p> --><ul><li>first<li>second</ul>
    <form><p>sign up</p></form><aside>side</aside><table><tr><td>cell<td>next</table><div id="comments"><p>bad</p></div><p hidden>gone</p></article>
    <footer>foot"""
    assert templates.main_text(page, set()) == "A & B!\none bold word\ntwo lines <x>\nfirst\nsecond\ncell\nnext"
    assert templates.main_text("", set()) == "" and templates.main_text("<p>", set()) == "" and templates.main_text("a < b <", set()) == "a < b <"
    assert templates.main_text("<div>x</b></div></p>y" * 3, set()) == "x\ny\nx\ny\nx\ny"
    assert len(templates.main_text("<div>" * 20_000 + "deep", set())) == 4


def test_no_article_is_lost_by_a_name():
    story = "<p>Whole story of some length</p>"
    text = "Whole story of some length"
    for page, want in (
        (f'<article class="post has-sidebar">{story}</article>', text),
        (f'<article class="hentry category-social">{story}</article>', text),
        (f'<article><section class="social-policy">{story}</section></article>', text),
        (f'<article><section class="comment-period-rules">{story}</section></article>', text),
        (f'<article><p id="related">{text}</p></article>', text),
        (f'<article><div class="story-login-law">{story}</div></article>', text),
        (f"<main>{story * 3}<article><p>teaser</p></article>{story * 3}</main>", "\n".join([text] * 3 + ["teaser"] + [text] * 3)),
        (f"<body><article>{story * 2}</article><article>{story}</article></body>", "\n".join([text] * 3)),
        # What the names are for still goes, and short teasers beside the article.
        (f'<article>{story}<div class="comment-list"><p>bad</p></div><div class="related-posts">x</div><p class="advert">x</p></article>', text),
        (f'<article>{story * 9}</article><article class="card"><p>teaser</p></article><aside><article>{story * 9}</article></aside>', "\n".join([text] * 9)),
        (f'<article>{story}</article><section id="comments"><article class="comment">{story * 4}</article></section>', text),
    ):
        assert templates.main_text(page, set()) == want, page


def test_recurring_subtrees_go_where_nothing_names_them(spark):
    def page(k, host):
        return f"<body><div class=x1><p>Welcome to {host}</p></div><div class=x2><p>Story {k} of {host}</p><div class=y>Read more at {host}</div></div></body>"

    rows = [(k, f"https://a.example/{k}", page(k, "a"), 1, "s") for k in range(30)] + [(100 + k, f"https://b.example/{k}", page(k, "b"), 1, "s") for k in range(3)]
    rows += [(None, None, None, 1, "s"), (7, "https://a.example/7", page(7, "a"), 1, "s"), (200, "no url", "<p>alone</p>", 1, "s")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, page int, host string")
    got = templates.extract(table).collect()
    assert len(got) == len(rows)
    texts = {(r.page_id, r.url): r.text for r in got}
    assert texts[(4, "https://a.example/4")] == "Story 4 of a" and texts[(7, "https://a.example/7")] == "Story 7 of a"
    assert texts[(101, "https://b.example/1")] == "Welcome to b\nStory 1 of b\nRead more at b"
    assert texts[(None, None)] == "" and texts[(200, "no url")] == "alone"
    assert templates.extract(table.limit(0)).count() == 0


def test_articles_of_the_supplied_pages(spark):
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    source = {r.page_id: r.html for r in table.collect()}
    for r in templates.extract(table).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        blocks = (re.sub(r"<br>|</?b>", "", part) for part in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


def test_copies_of_an_article_are_no_template(spark):
    bodies = [
        "<div class=body><p>The same story</p></div>", "<section>The same story</section>", "<ul><li>The same story</li></ul>",
        "<div><section><ol><li>The same story</li></ol></section></div>",
    ]
    rows = [
        (100 * n + k, f"https://{n}.example/{k}", f"<body><div class=x{k}>{k}</div><article><div class=related>{k}</div>{body}</article></body>")
        for n, body in enumerate(bodies) for k in range(8)
    ]
    got = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and {r.text for r in got} == {"The same story"}


def test_a_template_needs_no_share_of_its_host(spark):
    menu = "<div class=x><b>Section menu</b></div>"
    rows = [(k, f"https://big.example/{k}", f"<article><p>Story {k}</p>{menu if k < 6 else ''}</article>") for k in range(400)]
    rows += [(1000 + k, f"https://small.example/{k}", f"<article><p>Story {k}</p>{menu if k < 4 else ''}</article>") for k in range(10)]
    texts = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(texts[k] == f"Story {k}" for k in range(400))
    assert texts[1000] == "Story 0\nSection menu" and texts[1009] == "Story 9"

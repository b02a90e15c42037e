"""Main text of web pages: site template removal, then the article's blocks.

Each page's element subtrees are hashed; Spark counts with how many different articles of a host each occurs. Subtrees that recur with
``least_pages`` articles of their host, however large the host is, are the site's template and are deleted, unless they hold the
article or are running text. Pages whose texts are equal after the tag and class rules count as one article, so copies of an article are no
template, whatever elements hold their text. What the template rule cannot know on small hosts,
elements that are never article text (menus, forms, scripts, adverts, notices, comments ...), goes by tag, role and class. Of the rest the
article's blocks are kept: character references decoded, white space made one space, joined by a line feed.

Cases: null html is empty and gives empty text; unclosed and misnested elements end where their parents end; text that no element
holds counts as the body's; repeated and null ids and urls keep all their rows (pages without a host share one); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from bisect import bisect_left
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.shared import stored

_TOKEN = re.compile(r"<(?:!--(.*?)(?:--!?>|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z))", re.S)
_CLASSES = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption table tbody thead tfoot tr td th dl dt dd li".split())
NEVER = frozenset("head nav footer aside form dialog menu button select option datalist label fieldset audio video canvas object map".split()) | RAW
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navigation navbar breadcrumb breadcrumbs "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription comment comments disqus respond reply replies "
    "share sharing social related recommended footer widget toolbar pagination pager login signup skip".split()
)
# Words that say only where or what kind of box an element is: with them a name of NEVER_NAMES is still one.
BOX_NAMES = frozenset(
    "area article author banner bar block body bottom box button buttons card cards container content count form header icons inner item items left link links list main outer page panel post posts "
    "primary right secondary section site small sticky text this thread top wrap wrapper articles stories".split()
)
# Articles beside the longest one count from this share of its text on; those inside a main element from half of the main's text on.
SIBLING_SHARE, MAIN_SHARE = 3, 2
# Subtrees whose articles a task remembers at a time.
HELD = 200_000
# What ends an open element of the same list when it starts.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


@dataclass
class Element:
    tag: str
    attributes: str
    parent: int
    start: int
    end: int = -1


@dataclass
class Page:
    """A page's elements in order, and its text runs: (start, end, element), or None where a block begins or ends."""

    html: str
    elements: list[Element] = field(default_factory=list)
    runs: list[tuple[int, int, int] | None] = field(default_factory=list)


def parse(html: str) -> Page:
    page, stack, at = Page(html), [], 0

    def close(index: int, end: int) -> None:
        while stack and stack[-1] >= index:
            element = page.elements[stack.pop()]
            element.end = end
            if element.tag in BLOCKS:
                page.runs.append(None)

    while at < len(html):
        found = _TOKEN.search(html, at)
        stop = found.start() if found else len(html)
        if stop > at:
            page.runs.append((at, stop, stack[-1] if stack else -1))
        if not found:
            break
        at = found.end()
        tag = found[3].lower() if found[3] else None
        if tag is None:
            continue
        if found[2]:
            for index in reversed(stack):
                if page.elements[index].tag == tag:
                    close(index, at)
                    break
            continue
        if tag in BLOCKS and stack:
            for index in reversed(stack):
                name = page.elements[index].tag
                if name == "p" or name in SIBLINGS.get(tag, ()):
                    close(index, found.start())
                elif name in BLOCKS:
                    break
        if tag == "br" or tag == "wbr":
            page.runs.append((found.start(), found.start(), stack[-1] if stack else -1))
        if tag in BLOCKS:
            page.runs.append(None)
        page.elements.append(Element(tag, found[4], stack[-1] if stack else -1, found.start(), at))
        if tag in VOID or found[4].endswith("/") and tag in RAW:
            continue
        stack.append(len(page.elements) - 1)
        if tag in RAW:
            ending = re.compile(rf"</{re.escape(tag)}[\s/>]|\Z", re.I).search(html, at)
            at = html.find(">", ending.start()) + 1 or len(html) if ending.group() else len(html)
            close(len(page.elements) - 1, at)
    close(0, len(html))
    return page


def _names(element: Element) -> tuple[set[str], str, bool]:
    """Words of class, id and itemprop; the role; whether the element is hidden."""
    names, role, hidden = set(), "", False
    if element.attributes.strip(" /\n\t"):
        for found in _CLASSES.finditer(element.attributes):
            key, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
            if key == "role":
                role = value
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                hidden = True
            elif key in ("class", "id", "itemprop"):
                names |= set(_NAME.findall(value))
    return names, role, hidden


def named_away(element: Element) -> bool:
    """Whether a whole class or id says that the element is no article text: a name of ``NEVER_NAMES``, alone or with words for boxes.

    Words inside longer names do not count (``has-sidebar``, ``social-policy``), nor does the id of running text.
    """
    for match in _CLASSES.finditer(element.attributes) if element.attributes.strip(" /\n\t") else ():
        key = match[1].lower()
        if key in ("class", "id", "itemprop") and not (key == "id" and element.tag in RUNNING):
            for token in (match[2] or match[3] or match[4] or "").lower().split():
                parts = set(_NAME.findall(token))
                if parts & NEVER_NAMES and parts <= NEVER_NAMES | BOX_NAMES:
                    return True
    return False


def _text_sizes(page: Page):
    """A function from an element to the number of characters of its text."""
    runs = [run for run in page.runs if run is not None]
    starts = [run[0] for run in runs]
    sums = list(accumulate((len(page.html[a:b].strip()) for a, b, _ in runs), initial=0))
    return lambda index: sums[bisect_left(starts, page.elements[index].end)] - sums[bisect_left(starts, page.elements[index].start)]


def holders(page: Page) -> list[int]:
    """The elements that hold the article, none for the whole page.

    One element, or the ``article`` elements side by side that have text of about the same size; a ``main`` of which they are a small part
    holds the article itself.
    """
    best = article(page)
    if best < 0 or page.elements[best].tag != "article":
        return [best] * (best >= 0)
    # What lies in an article, or in an element that never belongs to one, is no article beside others.
    closed, found = [False] * len(page.elements), []
    for i, element in enumerate(page.elements):
        up = element.parent
        closed[i] = up >= 0 and (closed[up] or page.elements[up].tag == "article") or element.tag in NEVER or named_away(element)
        if element.tag == "article" and not closed[i]:
            found.append(i)
    size = _text_sizes(page)
    found = [i for i in found if SIBLING_SHARE * size(i) >= size(best)] if best in found else [best]
    up = page.elements[best].parent
    while up >= 0:
        if page.elements[up].tag == "main" and sum(map(size, found)) * MAIN_SHARE < size(up):
            return [up]
        up = page.elements[up].parent
    return found


def article(page: Page) -> int:
    """The element that looks most like the article, -1 for none."""
    best, rank = -1, 0
    for index, element in enumerate(page.elements):
        names, role, _ = _names(element)
        if element.tag == "article" and not named_away(element):
            own = 5
        elif element.tag == "main" or role == "main":
            own = 4
        elif "articlebody" in names:
            own = 3
        elif element.tag in ("div", "section", "td") and names & {"article", "post", "entry", "story", "content"} and not named_away(element):
            own = 2
        elif element.tag == "body":
            own = 1
        else:
            continue
        size = element.end - element.start
        if own > rank or own == rank and size > page.elements[best].end - page.elements[best].start:
            best, rank = index, own
    return best


def _around(page: Page, mains: list[int]) -> set[int]:
    around = set()
    for index in mains:
        while index >= 0:
            around.add(index)
            index = page.elements[index].parent
    return around


def candidates(page: Page, mains: list[int]) -> list[int]:
    """Elements that may belong to the site's template: no running text, and not around the article."""
    around = _around(page, mains)
    return [i for i, e in enumerate(page.elements) if e.tag in BLOCKS and e.tag not in RUNNING and e.tag not in ("html", "head", "body") and i not in around]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def subtree_hash(page: Page, index: int) -> int:
    element = page.elements[index]
    return _hash(" ".join(page.html[element.start:element.end].split()))


def main_text(html: str, template: set[int]) -> str:
    """The article's text without subtrees whose hash is in ``template`` and elements that never belong to it."""
    page = parse(html)
    mains = holders(page)
    return _kept_text(page, mains, {i for i in candidates(page, mains) if template and subtree_hash(page, i) in template})


def _kept_text(page: Page, mains: list[int], gone: set[int]) -> str:
    around, held = _around(page, mains), set(mains)
    drop, inside = [False] * len(page.elements), [False] * len(page.elements)
    for i, element in enumerate(page.elements):
        parent = element.parent
        inside[i] = i in held or parent >= 0 and inside[parent]
        if i in around:
            continue
        _, role, hidden = _names(element)
        out_of_place = element.tag == "header" and not inside[i]
        drop[i] = (
            parent >= 0 and drop[parent] or i in gone or element.tag in NEVER or out_of_place
            or role in NEVER_ROLES or hidden or named_away(element)
        )
    blocks, words = [], []
    for run in [*page.runs, None]:
        if run is None:
            text = " ".join(references.unescape("".join(words)).split())
            if text:
                blocks.append(text)
            words = []
            continue
        start, end, element = run
        if not mains or element >= 0 and inside[element] and not drop[element]:
            if element < 0 or not drop[element]:
                words.append(page.html[start:end] if end > start else " ")
    return "\n".join(blocks)


def _hashes(least: int):
    """Subtrees and article of each page; ``counted`` leaves out subtrees that the task has already counted with ``least`` articles or with this one."""
    def run(batches):
        seen: dict[tuple[str, int], tuple[int, ...]] = {}
        for batch in batches:
            rows, articles, counted = [], [], []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = parse(html)
                mains = holders(page)
                text = _hash(_kept_text(page, mains, set()))
                rows.append(sorted({subtree_hash(page, i) for i in candidates(page, mains)}))
                articles.append(text)
                counted.append([])
                for subtree in rows[-1]:
                    known = seen.get((host, subtree), ())
                    if len(known) < least and text not in known:
                        seen[host, subtree] = (*known, text)
                        counted[-1].append(subtree)
                if len(seen) > HELD:
                    seen = {}
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page"), batch.column("host"), pa.array(rows, kind), pa.array(articles, pa.int64()), pa.array(counted, kind)],
                ["page", "host", "subtrees", "article", "counted"],
            )

    return run


HASHED = "page long, host string, subtrees array<long>, article long, counted array<long>"


def extract(pages: DataFrame, least_pages: int = 5) -> DataFrame:
    """``page_id``, ``url`` and ``text``, one row per page."""
    html = F.coalesce("html", F.lit(""))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    # Equal pages of a host have the same subtrees: one row stands for them until texts are wanted.
    key = F.xxhash64(host, html)
    sources = pages.select("page_id", "url", host.alias("host"), html.alias("html"), key.alias("page"))
    hashed = stored(sources.select("page", "host", "html").mapInArrow(_hashes(least_pages), HASHED), "subtrees")
    seen = hashed.select("host", "article", F.explode("counted").alias("subtree")).groupBy("host", "subtree").agg(F.countDistinct("article").alias("on"))
    templates = seen.filter(F.col("on") >= least_pages).select("host", "subtree")
    found = (
        hashed.select("page", "host", F.explode("subtrees").alias("subtree")).distinct().join(templates, ["host", "subtree"])
        .groupBy("page").agg(F.collect_set("subtree").alias("template"))
    )

    @F.arrow_udf("string")
    def text_of(htmls: pa.Array, template: pa.Array) -> pa.Array:
        return pa.array([main_text(h, set(t or ())) for h, t in zip(htmls.to_pylist(), template.to_pylist())], pa.string())

    return sources.join(found, "page", "left").select("page_id", "url", text_of("html", "template").alias("text"))


@query("op8_templates")
def op8_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.char_length("text").cast("long"))

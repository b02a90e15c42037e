"""Reading links and article text out of stored HTML.

HTML nesting cannot be followed by column expressions, so this is the one place where pages go through
Python: an Arrow-batched UDF over the ``html`` column alone. All later steps are column expressions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from newsledger.functions.text import WHITESPACE
from newsledger.sources.profiles import PageProfile

EXTRACT_SCHEMA = "links array<struct<pos:int,title:string,href:string>>, body string, parse_error string"
_EXTRACTED = pa.struct(
    [
        ("links", pa.list_(pa.struct([("pos", pa.int32()), ("title", pa.string()), ("href", pa.string())]))),
        ("body", pa.string()), ("parse_error", pa.string()),
    ]
)
# Most pages, and about the most bytes of them, that are Python objects at a time, however many Spark sends at once.
MAX_PAGES, MAX_BYTES = 256, 4 * 1024 * 1024

# Elements without content, and elements whose text is no running text.
_VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
_SILENT = frozenset("script style template rt rp".split())


class _Area:
    """What was seen inside the first element matching one selector (or inside the whole page)."""

    def __init__(self, depth: int):
        self.depth, self.open = depth, True
        self.links: list[dict] = []
        self.pieces: list[str] = []


class _PageReader(HTMLParser):
    """One pass over a page; end tags close everything opened since the matching start tag."""

    def __init__(self, profile: PageProfile):
        super().__init__(convert_charrefs=False)
        self.selectors = tuple(dict.fromkeys(profile.link_areas + profile.text_areas))
        self.muted = _SILENT | set(profile.strip_tags)
        self.stack: list[str] = []
        self.open_tags: Counter[str] = Counter()
        self.open_links: list[tuple[int, dict]] = []
        self.muted_at: list[int] = []
        self.areas: dict = {None: _Area(0)}
        self.buffer: list[str] = []

    def _flush(self):
        text = "".join(self.buffer)
        self.buffer.clear()
        if not text:
            return
        for _, link in self.open_links:
            link["text"].append(text)
        piece = text.strip(WHITESPACE)
        if piece:
            muted = self.muted_at[-1] if self.muted_at else 0
            for area in self.areas.values():
                if area.open and muted <= area.depth:
                    area.pieces.append(piece)

    def _pop(self):
        depth = len(self.stack)
        self.open_tags[self.stack.pop()] -= 1
        if self.muted_at and self.muted_at[-1] == depth:
            self.muted_at.pop()
        if self.open_links and self.open_links[-1][0] == depth:
            self.open_links.pop()
        for area in self.areas.values():
            if area.depth == depth:
                area.open = False

    def updatepos(self, i, j):  # line and column are not needed
        return j

    def handle_starttag(self, tag, attrs):
        self._flush()
        values = {k: v or "" for k, v in attrs}
        self.stack.append(tag)
        self.open_tags[tag] += 1
        depth = len(self.stack)
        if tag == "a":
            link = {"title": values.get("title"), "href": values.get("href", ""), "text": []}
            for area in self.areas.values():
                if area.open:
                    area.links.append(link)
            self.open_links.append((depth, link))
        if tag in self.muted:
            self.muted_at.append(depth)
        for selector in self.selectors:
            if selector not in self.areas and selector.matches(tag, values):
                self.areas[selector] = _Area(depth)
        if tag in _VOID:
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._pop()

    def handle_endtag(self, tag):
        self._flush()
        if self.open_tags[tag]:
            while self.stack[-1] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_charref(self, name):
        self.buffer.append(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.buffer.append(html5.get(f"{name};", f"&{name}"))

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._flush()
        if data.startswith("CDATA["):
            self.buffer.append(data[6:])
            self._flush()

    def close(self):
        super().close()
        self._flush()

    def first(self, selectors) -> _Area | None:
        return next((self.areas[s] for s in selectors if s in self.areas), None)


def _read(html: str | None, profile: PageProfile) -> tuple[list[dict], str, str | None]:
    reader = _PageReader(profile)
    try:
        reader.feed(html or "")
        reader.close()
    except (AssertionError, ValueError) as error:  # markup the parser gives up on: no links, no text
        return [], "", f"{type(error).__name__}: {error}"
    links = []
    for link in (reader.first(profile.link_areas) or reader.areas[None]).links:
        title = "".join(link["text"]) if profile.title_from == "text" else link["title"]
        if title is not None:
            links.append(
                {
                    "pos": len(links),
                    "title": title.strip(WHITESPACE),
                    "href": link["href"].strip(WHITESPACE),
                }
            )
    area = reader.first(profile.text_areas)
    return links, "\n".join(area.pieces) if area else "", None


def _read_pieces(pages: pa.Array, profile: PageProfile) -> Iterator[pa.Array]:
    """What is read from the pages, a bounded piece at a time."""
    step = max(1, min(MAX_PAGES, MAX_BYTES * len(pages) // max(1, pages.nbytes)))
    for start in range(0, len(pages), step):
        read = (_read(h, profile) for h in pages.slice(start, step).to_pylist())
        yield pa.array([{"links": links, "body": body, "parse_error": error} for links, body, error in read], _EXTRACTED)


def read_page(html: Column, profile: PageProfile) -> Column:
    """``struct<links array<struct<pos,title,href>>, body string, parse_error string>`` of every page.

    ``parse_error`` is null but for pages that the parser gives up on, which have no links and no text.

    Links come in document order from the first link area found (else the whole page), untouched but
    for trimming. The body is every trimmed, non-empty text node of the first text area, joined by
    newlines, ``''`` when the page has no such area.
    """

    @F.arrow_udf(EXTRACT_SCHEMA)
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from _read_pieces(batch, profile)

    # Marked non-deterministic so that no filter on its result is moved below it, parsing pages twice.
    return extract.asNondeterministic()(html)

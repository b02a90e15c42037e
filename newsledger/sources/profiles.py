"""Per-site settings: where links and text are, which links count, which hosts are trusted."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Selector:
    """First element with this tag and, when given, this ``id`` or class."""

    tag: str
    id: str | None = None
    css_class: str | None = None

    def matches(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag != self.tag or (self.id is not None and attrs.get("id") != self.id):
            return False
        given = attrs.get("class", "")
        return self.css_class is None or self.css_class == given or self.css_class in given.split()


@dataclass(frozen=True)
class PageProfile:
    """How to read one source.

    ``href_all``/``href_any``: substrings of which all / at least one must occur in a link;
    ``title_none``: substrings of which none may occur in a title; ``allow_hosts``: trusted hosts,
    ``None`` for no check; ``title_from``: the link's ``title`` attribute (links without one do not
    count) or its ``text``.
    """

    source: str
    base_url: str
    prefix: str
    link_areas: tuple[Selector, ...] = ()
    text_areas: tuple[Selector, ...] = ()
    href_all: tuple[str, ...] = ()
    href_any: tuple[str, ...] = ()
    title_none: tuple[str, ...] = ()
    strip_tags: tuple[str, ...] = ("script", "style")
    allow_hosts: tuple[str, ...] | None = None
    title_from: str = "attribute"


# --------------------------------------------------------------------------------------------------
# The two built-in sources.
# --------------------------------------------------------------------------------------------------
REGULATOR = PageProfile(
    source="金管會",
    base_url="https://www.fsc.gov.tw",
    prefix="/ch/",
    link_areas=(Selector("div", id="content"), Selector("div", css_class="page_content")),
    text_areas=(
        Selector("div", css_class="content_block"),
        Selector("div", id="content"),
        Selector("div", css_class="page_content"),
    ),
    href_all=("id=",),
    href_any=("parentpath=0,2", "id=2&", "id=17&"),
    title_none=("回首頁", "網站導覽", "English", "常見問答", "聯絡我們", "機關介紹"),
    allow_hosts=("www.fsc.gov.tw",),
)

CENTRAL_BANK = PageProfile(
    source="中央銀行",
    base_url="https://www.cbc.gov.tw",
    prefix="/tw/",
    link_areas=(Selector("div", css_class="list"),),
    text_areas=(
        Selector("div", css_class="cp"),
        Selector("section", css_class="cp"),
        Selector("div", id="content"),
    ),
    href_all=("cp-302-",),
    strip_tags=("script", "style", "nav"),
)
# --------------------------------------------------------------------------------------------------

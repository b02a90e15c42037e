"""From stored pages to link entries and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsledger.functions.text import contains_all, contains_any, let
from newsledger.functions.urls import absolutize, is_allowed, is_allowed_after_redirect
from newsledger.operators.ranking import first_per_group
from newsledger.sources.html import read_page
from newsledger.sources.profiles import PageProfile


def redirect_guard(pages: DataFrame, hosts, url: str = "url", final_url: str = "final_url") -> DataFrame:
    """Pages whose requested and, if recorded, final URL are both on the allow-list."""
    final = F.col(final_url) if final_url in pages.columns else F.lit(None).cast("string")
    return pages.filter(is_allowed_after_redirect(F.col(url), final, hosts))


def read_pages(pages: DataFrame, profile: PageProfile, html: str = "html") -> DataFrame:
    """``links``, ``body`` and ``parse_error`` in place of the raw HTML: every page is parsed once for all."""
    page = F.col("__page")
    return (
        pages.withColumn("__page", read_page(F.col(html), profile))
        .withColumns({"links": page["links"], "body": page["body"], "parse_error": page["parse_error"]})
        .drop("__page", html)
    )


def keeps_link(title: Column, href: Column, profile: PageProfile) -> Column:
    """The profile's rules on one link before its URL is made absolute."""
    keep = (href != "") & contains_all(href, profile.href_all)
    if profile.title_none:
        keep = keep & ~contains_any(title, profile.title_none)
    if profile.href_any:
        keep = keep & contains_any(href, profile.href_any)
    return keep


def link_rows(read: DataFrame, profile: PageProfile, page_key: str = "page_id") -> DataFrame:
    """``(page_key, pos, title, url)`` of every link the profile keeps, repeats included."""
    rows = read.select(page_key, F.inline("links"))
    rows = rows.filter(keeps_link(F.col("title"), F.col("href"), profile)).select(
        page_key, "pos", "title", absolutize(F.col("href"), profile.base_url, profile.prefix).alias("url")
    )
    if profile.allow_hosts is not None:
        rows = rows.filter(is_allowed(F.col("url"), profile.allow_hosts))
    return rows


def first_by_url(links: DataFrame, page_key: str = "page_id") -> DataFrame:
    """The first link per page and URL, for links already in rows of their own. The partial aggregation
    removes repeats within a task before anything is shuffled."""
    return links.groupBy(page_key, "url").agg(F.min(F.struct("pos", "title")).alias("first")).select(
        page_key, "first.pos", "first.title", "url"
    )


def kept_links(links: Column, profile: PageProfile) -> Column:
    """``array<struct<url,pos,title>>``: the links the profile keeps, the first one per URL.

    Works inside the page's row: sorted by URL and position, a link counts when the one before it has
    another URL.
    """
    entries = F.transform(
        F.filter(links, lambda x: keeps_link(x["title"], x["href"], profile)),
        lambda x: F.struct(
            absolutize(x["href"], profile.base_url, profile.prefix).alias("url"),
            x["pos"].alias("pos"),
            x["title"].alias("title"),
        ),
    )
    if profile.allow_hosts is not None:
        entries = F.filter(entries, lambda x: is_allowed(x["url"], profile.allow_hosts))
    return let(
        F.array_sort(entries),
        lambda rows: F.filter(rows, lambda x, i: (i == 0) | (F.get(rows, i - 1)["url"] != x["url"])),
    )


def extract_links(pages: DataFrame, profile: PageProfile, page_key: str = "page_id", more: tuple[str, ...] = ()) -> DataFrame:
    """Link entries ``(page_key, pos, title, url)``, first occurrence per URL within a page; ``more`` columns of the page go along.

    All links of a page come out of one row, so nothing is shuffled.
    """
    kept = kept_links(F.col("links"), profile)
    more = tuple(c for c in more if c != page_key)
    read = read_pages(pages.select(page_key, *more, "html"), profile)
    return read.select(page_key, *[F.col(c).alias(f"__{c}") for c in more], F.inline(kept)).select(
        page_key, "pos", "title", "url", *[F.col(f"__{c}").alias(c) for c in more]
    )


def extract_text(pages: DataFrame, profile: PageProfile, errors: bool = False) -> DataFrame:
    """Pages with their article text as ``body`` instead of ``html``; with ``errors`` also why a page could not be read."""
    read = read_pages(pages, profile).drop("links")
    return read if errors else read.drop("parse_error")


def limit_per_source(entries: DataFrame, limit: int = 5, order: list[Column] | None = None) -> DataFrame:
    """The first ``limit`` different URLs per source in page order; a URL counts where it is listed first."""
    order = order or [F.col("page_id"), F.col("pos")]
    return first_per_group(first_per_group(entries, ["source", "url"], order, 1), ["source"], order, limit)


def link_entries(pages: DataFrame, profile: PageProfile, limit: int | None = None) -> DataFrame:
    """Entries of one source, labelled with it; only the first ``limit`` when given."""
    entries = extract_links(pages, profile).withColumn("source", F.lit(profile.source))
    return entries if limit is None else limit_per_source(entries, limit)


def entry_bodies(entries: DataFrame, pages: DataFrame, profile: PageProfile) -> DataFrame:
    """Entries with the text of the stored page behind their URL, ``''`` where none is stored.

    Of several pages with one URL the last fetch counts: the largest ``fetched_at`` or ``page_id``, if there is such a column, then the
    largest hash of the page. With an allow-list only pages reached without leaving it count. The join runs before
    parsing, so only pages that some entry asks for are parsed, each once.
    """
    if profile.allow_hosts is not None:
        pages = redirect_guard(pages, profile.allow_hosts)
    wanted = pages.join(entries.select("url").distinct(), "url", "left_semi")
    order = [F.col(c).desc() for c in ("fetched_at", "page_id") if c in pages.columns] + [F.xxhash64("html").desc()]
    wanted = first_per_group(wanted, ["url"], order, 1).select("url", "html")
    bodies = extract_text(wanted, profile).select("url", "body")
    return entries.join(bodies, "url", "left").withColumn("body", F.coalesce("body", F.lit("")))

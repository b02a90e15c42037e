"""Batch job: stored pages of several sources to new items."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger.operators.items import to_items, union_sources, with_dedup_key
from newsledger.operators.pages import entry_bodies, link_entries, redirect_guard
from newsledger.operators.stored import new_items
from newsledger.session import materialize
from newsledger.sources.profiles import PageProfile


@dataclass
class Source:
    """List pages (page_id, url, html) and article pages (url, html) of one site."""

    profile: PageProfile
    list_pages: DataFrame
    article_pages: DataFrame


def collect_entries(sources: list[Source], stored: DataFrame, limit: int | None = None) -> DataFrame:
    """New entries ``(site, source, title, url, dedup_key)`` of all sources, kept.

    Narrow rows, found before any article page is read and kept because they are used several times, so
    the list pages are parsed once. ``limit`` counts the entries per source as listed, known ones
    included; ``site`` is the position in ``sources``.
    """
    found = []
    for site, source in enumerate(sources):
        pages = source.list_pages
        if source.profile.allow_hosts is not None:
            pages = redirect_guard(pages, source.profile.allow_hosts)
        entries = link_entries(pages, source.profile, limit).withColumn("site", F.lit(site))
        found.append(entries.select("site", "source", "title", "url"))
    return new_items(with_dedup_key(materialize(union_sources(*found))), stored)


def items_of(entries: DataFrame, sources: list[Source], run_id: str | None = None) -> DataFrame:
    """Items of the entries, with the text of the stored article pages."""
    found = []
    for site, source in enumerate(sources):
        own = entries.filter(F.col("site") == site)
        found.append(to_items(entry_bodies(own, source.article_pages, source.profile), run_id))
    return union_sources(*found)


def collect_items(
    sources: list[Source], stored: DataFrame, run_id: str | None = None, limit: int | None = None
) -> DataFrame:
    """New items of all sources. Known articles are never parsed; repeats between sources stay."""
    return items_of(collect_entries(sources, stored, limit), sources, run_id)

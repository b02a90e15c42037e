"""URL columns: absolute form, host allow-list, redirect check, item key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsledger.functions.text import or_empty

# Characters which turn into one of ``/ ? # @ :`` under compatibility normalisation. A host part holding
# one of them is ambiguous and therefore refused.
_AMBIGUOUS = "[⁈⁉⁇℀℁℅℆⩴︓︖﹕﹖﹟﹫＃／：？＠]"


def absolutize(href: Column, base: str | Column, prefix: str | Column) -> Column:
    """``href`` itself when it starts with ``http``, else base, prefix and href joined."""
    base, prefix = (F.lit(x) if isinstance(x, str) else x for x in (base, prefix))
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, prefix, href))


def host_of(url: Column) -> Column:
    """Lower-case host of an http(s) URL, ``''`` for every other text."""
    tidy = F.translate(url, "\t\r\n", "")
    authority = F.regexp_extract(tidy, r"^[\x00-\x20]*(?i:https?)://([^/?#]*)", 1)
    host = F.lower(F.regexp_extract(authority, r"(?s)^(?:.*@)?([^:@]*)(?::[^@]*)?$", 1))
    odd = authority.rlike(r"[\[\]]") | authority.rlike(_AMBIGUOUS)
    return F.when(odd, F.lit("")).otherwise(host)


def is_allowed(url: Column, hosts: list[str] | tuple[str, ...]) -> Column:
    """True only for http/https URLs whose host is exactly one of ``hosts``."""
    return F.coalesce(host_of(url).isin([h for h in hosts if h]), F.lit(False))


def is_allowed_after_redirect(url: Column, final_url: Column, hosts) -> Column:
    """The requested URL and, where one is recorded, the final URL are both allowed."""
    return is_allowed(url, hosts) & is_allowed(F.coalesce(final_url, url), hosts)


def dedup_key(url: Column, title: Column) -> Column:
    """SHA-256 (hex) of the UTF-8 bytes of URL and title without a separator; null counts as ''."""
    return F.sha2(F.concat(or_empty(url), or_empty(title)), 256)

"""Small text helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space as trimmed from titles, links and text nodes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "               　"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Trim Unicode white space on both sides."""
    return F.btrim(text, F.lit(WHITESPACE))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def contains_any(text: Column, words: list[str] | tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def contains_all(text: Column, words: list[str] | tuple[str, ...]) -> Column:
    found = F.lit(True)
    for word in words:
        found = found & text.contains(word)
    return found

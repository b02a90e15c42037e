"""The rules as SQL.

The name rule is left out: the SQL engine has no lookahead, and no supplied table holds a CJK letter.
Its word boundary is an ASCII one; the supplied tables hold no hit whose neighbour makes a difference
(the tests compare with a Unicode-aware single pass on texts that do).
"""

from __future__ import annotations

from newsledger.functions.pii import RULES

SQL_RULES = [r for r in RULES if r.kind != "CHINESE_NAME"]


def combined(extra: str | None = None) -> str:
    groups = [f"({r.pattern})" for r in SQL_RULES] + ([f"({extra})"] if extra else [])
    return "'" + "|".join(groups) + "'"


def kinds_and_placeholders(extra: tuple[str, str] | None = None) -> list[tuple[str, str]]:
    return [(r.kind, r.placeholder) for r in SQL_RULES] + ([extra] if extra else [])


def is_safe(text: str) -> str:
    return f"NOT regexp_matches({text}, {combined()})"


def hit_lists(text: str, pattern: str, n: int) -> str:
    """One list per rule, aligned by hit, null where another rule won."""
    return "[" + ", ".join(f"regexp_extract_all({text}, {pattern}, {i + 1})" for i in range(n)) + "]"


def mask(text: str, extra_pattern: str | None = None, extra: tuple[str, str] | None = None) -> str:
    """Pieces between the hits, each followed by the placeholder of the rule that won."""
    pattern = combined(extra_pattern)
    rules = kinds_and_placeholders(extra)
    lists = hit_lists(text, pattern, len(rules))
    marks = "[" + ", ".join(f"'{p}'" for _, p in rules) + "]"
    first = "list_position(list_transform(bound.found, lambda l: coalesce(l[i], '') <> ''), true)"
    return f"""CASE WHEN regexp_matches({text}, {pattern}) THEN list_transform(
        [{{'found': {lists}, 'pieces': string_split_regex({text}, {pattern})}}],
        lambda bound: array_to_string(list_transform(bound.pieces,
          lambda piece, i: piece || coalesce({marks}[{first}], '')), ''))[1]
      ELSE {text} END"""

"""Many literal keywords as one pattern whose cost does not grow with their number.

A flat alternation tries every keyword at every position. Here keywords share their beginnings like the branches of a trie, and
where many branches leave, a class of first characters halves them, so a position costs the depth that the text follows.
"""

from __future__ import annotations

import re
from os.path import commonprefix

# Below this depth of branches the rest is a flat alternation, which keeps the pattern's nesting bounded.
DEEPEST = 48
FEW = 4


def escape_literal(text: str) -> str:
    """A pattern matching exactly ``text``, in character classes too."""

    def escaped(m: re.Match) -> str:
        if m[1] == "\\":
            return r"\x5c"  # a pair of backslashes before a letter would read as that letter's class
        return m[1] if m[1].isalnum() or m[1] == "_" else "\\" + m[1]

    return re.sub(r"([\x00-\x7f])", escaped, text)


def reachable(words: list[str]) -> list[str]:
    """Those that can win where the first of ``words`` that matches wins: no earlier word is a beginning of theirs.

    Of the rest the longest match wins, as a word is earlier than all its own beginnings.
    """
    place: dict[str, int] = {}
    for i, word in enumerate(words):
        place.setdefault(word, i)
    return [w for w, i in place.items() if all(place.get(w[:n], i) >= i for n in range(1, len(w)))]


def _choice(branches: list[tuple[str, str]]) -> str:
    """One of ``(first character, pattern)``, halved by classes of first characters."""
    if len(branches) <= FEW:
        return "|".join(pattern for _, pattern in branches)
    half = len(branches) // 2
    return "|".join(
        f"(?=[{''.join(escape_literal(c) for c, _ in part)}])(?:{_choice(part)})" for part in (branches[:half], branches[half:])
    )


def _trie(words: list[str], depth: int) -> str:
    """The longest of the sorted, distinct ``words``."""
    ends = words[0] == ""
    words = words[1:] if ends else words
    if not words:
        return ""
    if depth > DEEPEST:
        body = "|".join(escape_literal(w) for w in sorted(words, key=len, reverse=True))
        return f"(?:{body})?" if ends else f"(?:{body})"
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[0], []).append(word)
    branches = []
    for first, group in groups.items():
        shared = commonprefix(group)
        rest = [w[len(shared):] for w in group]
        branches.append((first, escape_literal(shared) + _trie(rest, depth + 1)))
    body = _choice(branches)
    if ends:
        return f"(?:{body})?"
    return body if len(branches) == 1 else f"(?:{body})"


def keyword_pattern(words: list[str]) -> str:
    """Matches what an alternation of the literal ``words`` in their order matches."""
    return _trie(sorted(reachable(words)), 0)

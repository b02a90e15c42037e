"""Detecting and masking personal data with one ordered pass over a text.

All rules are joined into one alternation, so a text is read once from left to right: the leftmost hit
wins, among hits with the same start the earlier rule wins, and hits never overlap. Chained
replacements, one rule after the other, would give other results.

Everything is a Spark expression. Two things keep it cheap:

* a *gate* (one small character class, plus byte-level ``contains``) drops texts which cannot hold a
  hit, so that most texts never meet the alternation;
* every rule starts with a look at its possible first character, which the regex engine tests before
  the expensive part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsledger.functions.keywords import escape_literal, keyword_pattern
from newsledger.functions.text import let

# --------------------------------------------------------------------------------------------------
# Surnames, context words, rule patterns and placeholders.
# ``\b``, ``\d`` and ``\s`` have their Unicode meaning, see ``jvm_pattern``.
# --------------------------------------------------------------------------------------------------
SURNAMES = (
    "趙錢孫李周吳鄭王馮陳褚衛蔣沈韓楊朱秦尤許"
    "何呂施張孔曹嚴華金魏陶姜戚謝鄒喻柏水竇章"
    "雲蘇潘葛奚范彭郎魯韋昌馬苗鳳花方俞任袁柳"
    "酆鮑史唐費廉岑薛雷賀倪湯滕殷羅畢郝鄔安常"
    "傅卞齊元顧孟平黃和穆蕭尹姚邵湛汪祁毛禹狄"
    "米貝明臧計伏成戴談宋茅龐熊紀舒屈項祝董梁"
    "杜阮藍閔席季麻強賈路婁危江童顏郭梅盛林刁"
    "鐘徐丘駱高夏蔡田樊胡凌霍虞萬支柯昝管盧莫"
)
NAME_CONTEXT = "先生|小姐|女士|客戶|員工|用戶|帳戶|貸款|的|之|申請|查詢"
NAME_CHARS = "○Ｘ●＊一-鿿"


@dataclass(frozen=True)
class PiiRule:
    """One rule.

    ``pattern`` has no capturing group and never matches the empty text. ``first`` is a lookahead body
    every match fulfils at its start, ``needs`` a character class of which every match holds a
    character (``None``: unknown, the rule then opens the gate for every text). ``engine`` replaces
    ``pattern`` on the JVM by an equivalent form.
    """

    kind: str
    placeholder: str
    pattern: str
    first: str | None = None
    needs: str | None = None
    engine: str | None = None


RULES: tuple[PiiRule, ...] = (
    PiiRule("TAIWAN_ID", "[TAIWAN_ID]", r"[A-Z][12]\d{8}", "[A-Z]", r"\d"),
    PiiRule(
        "CREDIT_CARD", "[CREDIT_CARD]", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", r"\d", r"\d"
    ),
    PiiRule("PHONE_MOBILE", "[PHONE_MOBILE]", r"\b09\d{2}[-\s]?\d{3}[-\s]?\d{3}\b", "0", r"\d"),
    PiiRule(
        "PHONE_LANDLINE", "[LANDLINE]", r"\b0[2-8][-\s]?\d{3,4}[-\s]?\d{4}(?:\s*#\d{1,6})?\b", "0", r"\d"
    ),
    PiiRule(
        "EMAIL",
        "[EMAIL]",
        r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b",
        r"[A-Za-z0-9._%+\-]",
        "@",
    ),
    PiiRule("BANK_ACCOUNT", "[BANK_ACCOUNT]", r"\b\d{10,14}\b", r"\d", r"\d"),
    PiiRule("RESIDENT_CERT", "[RESIDENT_CERT]", r"\b[A-Z]{1,2}\d{8}\b", "[A-Z]", r"\d"),
    PiiRule("TXN_ID", "[TXN_ID]", r"\b(?:TXN|TRX)\d{8,14}\b", "T", r"\d"),
    PiiRule("EMP_ID", "[EMP_ID]", r"\bEMP\d{4,8}\b|\bE\d{5,6}\b", "E", r"\d"),
    PiiRule("IP_ADDR_V4", "[IP_ADDR]", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", r"\d", r"\d"),
    PiiRule(
        "IP_ADDR_V6",
        "[IP_ADDR]",
        r"\b(?:[0-9a-fA-F]{1,4}:){2,7}[0-9a-fA-F]{1,4}\b"
        r"|(?:[0-9a-fA-F]{1,4}:)*::(?:[0-9a-fA-F]{1,4}:)*[0-9a-fA-F]{1,4}",
        "[0-9a-fA-F]{0,4}:",
        ":",
        # The same matches with possessive loops: java.util.regex runs these without recursion, so a
        # hex dump of many thousand groups cannot overflow the stack of a task.
        engine=r"\b(?:[0-9a-fA-F]{1,4}:){2,7}[0-9a-fA-F]{1,4}\b"
        r"|(?:[0-9a-fA-F]{1,4}:)*+::[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4})*+",
    ),
    PiiRule(
        "CHINESE_NAME",
        "[CHINESE_NAME]",
        f"[{SURNAMES}][{NAME_CHARS}]{{1,3}}(?={NAME_CONTEXT})",
        f"[一-鿿][{NAME_CHARS}]{{1,3}}?(?:{NAME_CONTEXT})",
        "一-鿿",
    ),
)
CUSTOM_KIND, CUSTOM_PLACEHOLDER, UNKNOWN_PLACEHOLDER = "CUSTOM", "[CUSTOM]", "[REDACTED]"
# --------------------------------------------------------------------------------------------------

# Unicode letters, numbers and underscore; decimal digits; white space including the four ASCII
# separators. Spelled out because the shorthand classes of java.util.regex differ in the details. The
# digit U+1D7D8 is in the class anyway; named literally it makes lookbehind step over whole characters
# beyond the BMP instead of half ones.
_WORD = r"\p{L}\p{N}_" + "\U0001d7d8"
_DIGIT = r"\p{Nd}"
_SPACE = r"\t-\r\x1c-\x20\x85\xa0  -     　"
_EDGE = f"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"

# Unicode noncharacters used to mark hits. A text holding one of them takes the slower exact branch.
_MARK, _SLOT, _STAND_IN = "﷐", "﷑", "﷒"


def jvm_pattern(pattern: str) -> str:
    """``pattern`` for java.util.regex, with ``\\b``, ``\\d``, ``\\s`` in their full Unicode meaning."""
    pattern = pattern.replace(r"[-\s]", f"[-{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
    return pattern.replace(r"\d", _DIGIT).replace(r"\b", _EDGE)


def custom_rule(keywords: list[str]) -> PiiRule:
    """The lowest rule: any of the caller's literal keywords, tried in the caller's order."""
    for word in keywords:
        if not word:
            raise ValueError("an empty keyword would match everywhere")
        if any(c in word for c in (_MARK, _SLOT, _STAND_IN)):
            raise ValueError("keywords must not hold the noncharacters U+FDD0 to U+FDD2")
    first = f"[{''.join(escape_literal(c) for c in sorted({w[0] for w in keywords}))}]"
    return PiiRule(CUSTOM_KIND, CUSTOM_PLACEHOLDER, keyword_pattern(keywords), first)


# So many keywords are looked for one by one, more of them by their common pattern.
SINGLE_KEYWORDS = 8


class PiiScanner:
    """The active rules in priority order and the Spark expressions built from them."""

    def __init__(self, custom_keywords: list[str] | None = None, rules: tuple[PiiRule, ...] = RULES):
        self.keywords = list(custom_keywords or [])
        self.rules = tuple(rules) + ((custom_rule(self.keywords),) if self.keywords else ())
        for rule in self.rules:
            compiled = re.compile(rule.pattern)
            if compiled.groups or compiled.match(""):
                raise ValueError(f"{rule.kind}: no capturing groups and no empty matches, please")
        self.kinds = [r.kind for r in self.rules]
        self.pattern = "|".join(self._alternative(r) for r in self.rules)
        # hit -> MARK, then one slot per rule of which only the slot of the winning rule has text
        slots = _SLOT.join(f"${i}" for i in range(1, len(self.rules) + 1))
        self._marked = f"{_MARK}{slots}{_MARK}"

    @staticmethod
    def _alternative(rule: PiiRule) -> str:
        body = jvm_pattern(rule.engine or rule.pattern)
        if rule.first is None:
            return f"({body})"
        return f"(?={jvm_pattern(rule.first)})({body})"

    # -- gate and flag -----------------------------------------------------------------------------
    def may_hit(self, text: Column) -> Column:
        """Cheap and necessary: false only where no rule can match."""
        fixed = [r for r in self.rules if r.kind != CUSTOM_KIND or not self.keywords]
        if any(r.needs is None for r in fixed):
            return text.isNotNull()
        gate = F.lit(False)
        if fixed:
            needed = "".join(dict.fromkeys(jvm_pattern(r.needs) for r in fixed))
            gate = text.rlike(f"[{needed}]")
        if len(self.keywords) > SINGLE_KEYWORDS:
            return gate | text.rlike(jvm_pattern(self.rules[-1].pattern))
        for word in self.keywords:
            gate = gate | text.contains(word)
        return gate

    def is_safe(self, text: Column) -> Column:
        """True iff no rule matches; true for null and empty texts."""
        return ~F.coalesce(self.may_hit(text) & text.rlike(self.pattern), F.lit(False))

    # -- hits --------------------------------------------------------------------------------------
    def _rule_index(self, slots: Column) -> Column:
        return F.length(slots) - F.length(F.ltrim(slots, F.lit(_SLOT))) + F.lit(1)

    def _mark(self, text: Column) -> Column:
        return F.split(F.regexp_replace(text, self.pattern, self._marked), _MARK)

    def _is_plain(self, text: Column) -> Column:
        return ~(text.contains(_MARK) | text.contains(_SLOT))

    def hits(self, text: Column) -> Column:
        """``array<struct<kind,value>>`` in text order, empty where nothing matches."""
        names = F.array(*map(F.lit, self.kinds))
        # No rule matches a marker character, so exchanging those of the text changes no hit.
        neutral = F.when(self._is_plain(text), text).otherwise(
            F.translate(text, _MARK + _SLOT, _STAND_IN * 2)
        )
        slots = F.filter(self._mark(neutral), lambda _, i: i % 2 == 1)
        found = F.transform(
            slots,
            lambda s: F.struct(
                F.element_at(names, self._rule_index(s)).alias("kind"),
                F.btrim(s, F.lit(_SLOT)).alias("value"),
            ),
        )
        nothing = F.array().cast("array<struct<kind:string,value:string>>")
        return F.when(self.may_hit(text), found).otherwise(nothing)

    def hit_kinds(self, text: Column) -> Column:
        return F.transform(self.hits(text), lambda h: h["kind"])

    def counts(self, text: Column) -> Column:
        """``map<kind,int>`` of the kinds which occur; empty for null."""
        def count(kinds: Column) -> Column:
            counted = F.transform(
                F.array_distinct(kinds),
                lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k))),
            )
            return F.map_from_entries(counted)

        return let(self.hit_kinds(text), count)

    # -- mask --------------------------------------------------------------------------------------
    def mask(self, text: Column) -> Column:
        """Every hit replaced by its placeholder, the rest unchanged; ``''`` for null."""
        marks = F.array(*[F.lit(r.placeholder or UNKNOWN_PLACEHOLDER) for r in self.rules])

        def placeholder(slots):
            return F.element_at(marks, self._rule_index(slots))

        one_pass = F.transform(
            self._mark(text), lambda s, i: F.when(i % 2 == 0, s).otherwise(placeholder(s))
        )
        neutral = F.translate(text, _MARK + _SLOT, _STAND_IN * 2)
        codes = F.filter(self._mark(neutral), lambda _, i: i % 2 == 1)
        two_pass = F.zip_with(
            F.split(text, self.pattern, -1),
            F.transform(codes, placeholder),
            lambda plain, mark: F.concat(plain, F.coalesce(mark, F.lit(""))),
        )
        masked = F.array_join(F.when(self._is_plain(text), one_pass).otherwise(two_pass), "")
        return F.when(self.may_hit(text), masked).otherwise(F.coalesce(text, F.lit("")))

"""Secrets in texts: fixed patterns, and strings near sensitive words that a primed compressor cannot shorten.

Base spans are the matches of three patterns (assigned values, access ids, long hexadecimal runs). The method adds strings
near a sensitive word that are new to their surroundings: a candidate costs as many bytes as zstandard needs more for its
surroundings with the candidate than without it, the compressor being primed with a dictionary of identifiers. Names, words and
repeated values cost little, as the compressor refers back to them; a key or a generated password costs nearly its length.

The identifiers come from the corpus: words in the surroundings of all sensitive words of all documents, counted by Spark.
A word counts once for each different passage before a sensitive word, so copies of a document count once, and words with digits
are never identifiers. The most frequent ones (``IDENTIFIERS``, bounded) prime the compressor, besides those of common code.
Strings with digits or mixed letters are reported from ``BYTES_A_CHAR`` on, those of plain words from ``PLAIN_BYTES_A_CHAR`` on.

Cases: null text counts as empty and has no spans; null and repeated ids keep all their rows; whole texts are read, of
any length; offsets are code points; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.shared import documents, kept_by_worker, texts_of
from newsledger.llm.token_files import slices

# The kinds in order, their patterns and least lengths, and the words of code that any dictionary holds.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
ASSIGNED, ACCESS_LENGTH = 6, 20
CODE = (
    "abstract access account address algorithm application argument array assert async attribute authorization await base64 "
    "bearer bool boolean break bucket builder bytes callback case catch certificate char class client column command config configuration connection "
    "const constructor content context continue controller cookie credential credentials data database debug decode default define delete "
    "description dict digest document double else email encode encoding endpoint enum environment error event except export "
    "extends factory false field file filename final finally float for format from function global group handler hash header headers host "
    "hostname http https identifier if implements import include index input instance int integer interface issuer item json "
    "jwt key keys lambda length level library license list load local localhost location log logger long manager map message method module "
    "name namespace new null number object option options output package page parameter parameters params parse passphrase "
    "passwd password path payload port private profile project protected provider public query raise random read refresh "
    "region register request require response result return role root schema scope secret secrets self server service session "
    "setting settings sha256 signature size socket source static status std storage string struct super switch table target "
    "template test this throw timeout timestamp token tokens true try type undefined update upload uri url user username users uuid "
    "value values var variable vector version virtual void volume while with write yield"
)
SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase|code)|secret|token|credential|api[ _-]?key|(?:access|private|signing|encryption|account|master|ssh)[ _-]?key"
    r"|authori[sz]ation|bearer|signature|connection[ _-]?string|(?<![A-Za-z])(?:pwd|jwt|auth)(?![a-z])",
    re.IGNORECASE | re.ASCII,
)
# Each match of SENSITIVE holds one of these, and each match of ASSIGN one of the first two lines.
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
HINTS = (*ASSIGN_HINTS, "passp", "passc", "credential", "key", "authori", "bearer", "signature", "connection", "pwd", "jwt", "auth")
CANDIDATE = re.compile(r"(?<!\w)[A-Za-z0-9+/_.~=-]+(?!\w)")
EDGES = "._-~="
MIXED = re.compile("[0-9]|[a-z].*[A-Z]|[A-Z].*[a-z].*[A-Z]")
WORD = re.compile("[A-Za-z_]{3,32}")

IDENTIFIERS = 4096
PASSAGES = 3
SHORTEST = 16
NEAR = 48
AROUND = 512
LEVEL = 6
BYTES_A_CHAR = 0.66
PLAIN_BYTES_A_CHAR = 0.9
FOUND = "doc_id long, spans array<struct<kind:string,start:long,end:long,novelty:double>>"


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """Start, number of the kind and end of the base spans; ``low`` is the text in lower case."""
    found = []
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def sensitive(text: str, low: str) -> list[re.Match]:
    return list(SENSITIVE.finditer(text)) if any(hint in low for hint in HINTS) else []


def candidates(text: str, hits: list[re.Match], taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Strings that begin within ``NEAR`` characters after a sensitive word and overlap no span in ``taken`` (sorted by start)."""
    found, last, at, most = [], 0, 0, 0
    for hit in hits:
        for m in CANDIDATE.finditer(text, max(last, hit.end())):
            if m.start() > hit.end() + NEAR:
                break
            last = m.end()
            start = m.start() + len(m[0]) - len(m[0].lstrip(EDGES))
            end = m.end() - len(m[0]) + len(m[0].rstrip(EDGES))
            if end - start < SHORTEST:
                continue
            while at < len(taken) and taken[at][0] < end:
                most, at = max(most, taken[at][2]), at + 1
            if most <= start:
                found.append((start, end))
    return found


class Novelty:
    """What a string costs next to its surroundings, with a dictionary of identifiers known."""

    def __init__(self, identifiers: str):
        import zstandard

        known = zstandard.ZstdCompressionDict(f"{CODE} {CODE.title()} {identifiers}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(dict_data=known, write_content_size=False).compress

    def bytes_a_char(self, text: str, start: int, end: int) -> float:
        around = f"{text[max(0, start - AROUND):start]} {text[end:end + AROUND]}\n".encode(errors="replace")
        return (len(self.compress(around + text[start:end].encode())) - len(self.compress(around))) / (end - start)


def spans(text: str, novelty: Novelty) -> list[dict]:
    """All spans of one text, by start and kind; each with its bytes a character."""
    low = text.lower()
    base = base_spans(text, low)
    added = [(start, 3, end) for start, end in candidates(text, sensitive(text, low), base)]
    found = []
    for start, kind, end in sorted(base + added):
        cost = novelty.bytes_a_char(text, start, end)
        if kind < 3 or cost >= (BYTES_A_CHAR if MIXED.search(text, start, end) else PLAIN_BYTES_A_CHAR):
            found.append({"kind": KINDS[kind], "start": start, "end": end, "novelty": cost})
    return found


def _passages(batches):
    """Words around sensitive words, up to the next one on each side, with a hash of the passage before the sensitive word."""
    for batch, texts in slices(batches):
        seen = set()
        for text in texts:
            hits = sensitive(text, text.lower())
            starts, ends = [h.start() for h in hits], [h.end() for h in hits]
            for start, end, before, after in zip(starts, ends, [0, *ends], [*starts[1:], len(text)]):
                passage = hashlib.blake2b(text[max(0, start - NEAR):end].encode(errors="replace"), digest_size=8).digest()
                name = int.from_bytes(passage, "little", signed=True)
                around = text[max(before, start - AROUND):min(after, end + AROUND)]
                seen.update((m[0], name) for m in WORD.finditer(around))
        words, names = zip(*seen) if seen else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(names, pa.int64())], ["word", "passage"])


def identifiers(docs: DataFrame, most: int = IDENTIFIERS, passages: int = PASSAGES) -> str:
    """The words found around sensitive words in the most passages (``passages`` at least), most frequent last."""
    words = texts_of(docs).select("text").mapInArrow(_passages, "word string, passage long").distinct()
    counts = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= passages)
    chosen = counts.orderBy(F.col("n").desc(), "word").limit(most).collect()
    return " ".join(r.word for r in reversed(chosen))


def find(docs: DataFrame, known: str) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, novelty), one row per document; ``known`` are the identifiers."""

    def run(batches):
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))
        novelty = kept_by_worker(("novelty", known), lambda: Novelty(known))
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([spans(t, novelty) for t in texts], kinds)], ["doc_id", "spans"])

    return texts_of(docs).mapInArrow(run, FOUND)


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op12_secret_novelty")
def op12_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = find(docs, identifiers(docs))
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = ((F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS)
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))

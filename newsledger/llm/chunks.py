"""Encoding whole texts with a public tokenizer, each distinct chunk of text once.

The pre-tokenizers of both vocabularies never join characters across a step from a non-space to a space, so
texts may be cut there and the pieces encoded by the tokenizers library one by one, with the ids of a piece
kept for its next occurrence. Texts with white space that the rule does not cover go to the library whole.
The kept pieces are bounded by memory: when they are too many, those that returned most often stay. Long pieces and longer
numbers, which seldom return, are not kept.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import chain, repeat

import numpy as np

from newsledger.llm.shared import kept_by_worker

# The names of the vocabulary files, and white space other than the blank and the line feed.
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
_ODD_SPACE = re.compile("[\x01\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CONTROL = re.compile("[\x1c-\x1f]")
_CHUNK = re.compile(r"\s*\S+|\s+")
# A comma or full stop between a Latin letter or digit and white space is a piece of its own.
_STOP = re.compile("[.,](?<=[A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\u024f][.,])(?=[ \n]|\\Z)")
_WORD = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def byte_chars() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


_BYTE_CHARS = byte_chars()
LONGEST = 48
LONGEST_NUMBER = 4
PIECE_BYTES = 250
PART = 1_500_000
_DIGIT = re.compile("[0-9]")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, installed alike on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """``encode(texts)`` gives one flat array of ids and the number of ids per text."""

    def __init__(self, path: str, megabytes: int = 190):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # A kept piece takes some 250 bytes: its text, its place in the index and the arrays, its ids.
        self.kept = megabytes * 1_000_000 // PIECE_BYTES
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int32)
        self.hits = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.entries = self.used = 0

    def _encode_new(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers for distinct chunks. A word of Latin letters is one pre-token, so the model alone does."""
        found, model = [], self.tokenizer.model
        for chunk in chunks:
            if _WORD.fullmatch(chunk) and self.plain(chunk):
                word = chunk.encode().decode("latin-1").translate(_BYTE_CHARS)
                found.append([token.id for token in model.tokenize(word)])
            else:
                found.append(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    def plain(self, chunk: str) -> bool:
        """Whether normalising leaves the chunk as it is."""
        return True

    def _add(self, keys: list[str]) -> int:
        """Adds distinct keys, those not to be kept last; gives the number of those that are kept."""
        passing = [len(k) > LONGEST or (len(k) > LONGEST_NUMBER and _DIGIT.search(k) is not None) for k in keys]
        kept = [k for k, p in zip(keys, passing) if not p]
        for part in (kept, [k for k, p in zip(keys, passing) if p]):
            self._append(part, *self._encode_new([self.chunk(k) for k in part]))
        return len(kept)

    def _append(self, keys: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, total = len(keys), len(ids)
        while self.entries + n > len(self.starts):
            self.starts, self.lengths, self.hits = (np.resize(a, 2 * len(a)) for a in (self.starts, self.lengths, self.hits))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used:self.used + total] = ids
        rows = slice(self.entries, self.entries + n)
        self.starts[rows] = self.used + np.cumsum(counts) - counts
        self.lengths[rows] = counts
        self.hits[rows] = 0
        self.index.update(zip(keys, range(self.entries, self.entries + n)))
        self.entries += n
        self.used += total

    def _shrink(self) -> None:
        """Keeps the half of the pieces that returned most often; what a piece has returned counts half from then on."""
        hits = self.hits[:self.entries]
        least = max(1, int(np.partition(hits, self.entries // 2)[self.entries // 2]) + 1)
        stay = np.flatnonzero(hits >= least)
        counts = self.lengths[stay].astype(np.int64)
        ends = np.cumsum(counts)
        self.used = int(ends[-1]) if len(ends) else 0
        self.ids[:self.used] = self.ids[np.repeat(self.starts[stay] - (ends - counts), counts) + np.arange(self.used)]
        place = np.full(self.entries, -1)
        place[stay] = np.arange(len(stay))
        self.index = {k: at for k, at in zip(self.index, place[np.fromiter(self.index.values(), np.int64, len(self.index))].tolist()) if at >= 0}
        self.entries = len(stay)
        self.starts[:self.entries], self.lengths[:self.entries], self.hits[:self.entries] = ends - counts, counts, hits[stay] // 2

    def keys(self, text: str) -> list[str]:
        """Keys of the pieces of the text that may be encoded apart: a word after a blank, or \\x01 and a piece as it is."""
        if not text:
            return []
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or _ODD_SPACE.search(text):
            return ["\x01" + text] if _CONTROL.search(text) else ["\x01" + c for c in _CHUNK.findall(text)]
        return ("\x01" + _STOP.sub(" \x01\\g<0>", text).replace("\n", " \x01\n \x01")).split(" ")

    def chunk(self, key: str) -> str:
        return key[1:] if key[:1] == "\x01" else " " + key

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, batch, size = [], [], 0
        for text in texts:
            batch.append(text)
            size += len(text)
            if size > PART:
                parts.append(self._encode(batch))
                batch, size = [], 0
        parts.append(self._encode(batch))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = [self.keys(text) for text in texts]
        flat = list(chain.from_iterable(pieces))
        if self.entries > self.kept:
            self._shrink()
        at = np.fromiter(map(self.index.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(at < 0)
        new, kept, before = [], 0, self.entries
        if len(unknown):
            missing = [flat[i] for i in unknown.tolist()]
            new = list(dict.fromkeys(missing))
            kept = self._add(new)
            at[unknown] = np.fromiter(map(self.index.__getitem__, missing), np.int64, len(missing))
        self.hits[:self.entries] += np.bincount(at, minlength=self.entries).astype(np.int32)
        counts = self.lengths[at].astype(np.int64)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[at] - (ends - counts), counts) + np.arange(total)]
        if kept < len(new):
            # The pieces not to be kept are the last ones.
            for key in [k for k in new if self.index[k] >= before + kept]:
                del self.index[key]
            self.entries, self.used = before + kept, int(self.starts[before + kept])
        borders = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        sums = np.concatenate([[0], ends])[borders]
        return ids, np.diff(sums, prepend=0)


class WordEncoder(ChunkEncoder):
    """For vocabularies that drop white space: the pieces are the words themselves."""

    def keys(self, text: str) -> list[str]:
        if _CONTROL.search(text) or "\x01" in text:
            return ["\x01" + text]
        if "<|" not in text:
            text = text.encode().translate(_LOWER).decode()
        return _STOP.sub(" \\g<0>", text).split()

    def chunk(self, key: str) -> str:
        return key[1:] if key[:1] == "\x01" else key

    def plain(self, chunk: str) -> bool:
        return chunk.islower() and chunk[0] != " " and unicodedata.is_normalized("NFC", chunk)


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder, kept from task to task until the worker needs another operator's model."""
    return kept_by_worker(("encoder", path), lambda: WordEncoder(path) if path.endswith(WORD_BPE) else ChunkEncoder(path))


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's, and the offsets of the texts (one more than texts)."""
    ends = np.cumsum(counts)
    out = np.insert(ids, ends, end_id) if len(counts) else ids
    return out, np.concatenate([[0], ends + np.arange(1, len(counts) + 1)]).astype(np.int64)

"""Byte-level BPE encoding and decoding in numpy: merge rounds over the symbols of many words at once.

All words of a batch that are not known yet lie in one flat array of symbols. Each round finds every neighbouring pair's
rank by binary search over the sorted pair keys and merges, in each word, all occurrences of its lowest-ranked pair; words
without a pair left are done. (A pair made by a merge always ranks after it, so merging one rank at once gives what merging
one pair at a time gives.) Ids of words are kept for their next occurrence, within a bound. Ids decode through one gather over the tokens' bytes.

Cases: null text is empty and has no ids; the special token's string in a text is that token, as with the tokenizers
library; null and repeated ids keep all their rows; an empty table gives no rows; further columns are kept by the column functions.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.llm import query
from newsledger.llm.chunks import BYTE_BPE, ChunkEncoder, byte_chars, vocabulary
from newsledger.llm.shared import documents, texts_of

# Fixed value: how the vocabulary's pre-tokenizer cuts texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_PAIR = np.int64(1) << 40


class MergeTable:
    """A vocabulary file's merges as arrays, and its tokens' bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab = data["model"]["vocab"]
        chars = {chr(c): b for b, c in byte_chars().items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        keys = (left << 20) | right
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.of_byte = np.array([vocab[chr(byte_chars()[b])] for b in range(256)], np.int64)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        tokens = vocab | self.special
        raw = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            raw[i] = token.encode() if token in self.special else bytes(chars[c] for c in token)
        self.sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (not empty) words in a row, and their numbers."""
        counts = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), counts)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            keys = (symbols[:-1] << 20) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where((self.keys[at] == keys) & (word[:-1] == word[1:]), self.ranks[at], NO_PAIR)
            rank = np.append(rank, NO_PAIR)
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(word)))
            best = np.repeat(lowest, sizes)
            done = best == NO_PAIR
            if done.any():
                finished.append((word[done], symbols[done]))
                going = ~done
                symbols, word, rank, best = symbols[going], word[going], rank[going], best[going]
                if not len(symbols):
                    break
            hit = rank == best
            # In a row of overlapping occurrences every second one counts, from the left.
            index = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), index, 0))
            hit &= (index - run_start) % 2 == 0
            symbols = np.where(hit, self.merged[np.where(hit, rank, 0)], symbols)
            stay = ~np.append(False, hit[:-1])
            symbols, word = symbols[stay], word[stay]
        owners = np.concatenate([f[0] for f in finished]) if finished else np.zeros(0, np.int64)
        ids = np.concatenate([f[1] for f in finished]) if finished else np.zeros(0, np.int64)
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(words))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens in a row."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class BatchedBpe(ChunkEncoder):
    """``encode(texts)``: one flat array of ids and the number of ids per text, by merge rounds."""

    def __init__(self, path: str, kept: int = 600_000):
        self.table = MergeTable(path)
        self.words = regex.compile(WORDS)
        special = "|".join(map(regex.escape, sorted(self.table.special, key=len, reverse=True)))
        self.special = regex.compile(f"({special})") if special else None
        self.kept = kept
        self._clear()

    def _encode_new(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words: dict[str, int] = {}
        rows = []
        for chunk in chunks:
            row = []
            for part in self.special.split(chunk) if self.special else [chunk]:
                if part in self.table.special:
                    row.append(-1 - self.table.special[part])
                else:
                    row += [words.setdefault(w, len(words)) for w in self.words.findall(part)]
            rows.append(row)
        ids, sizes = self.table.encode_words([w.encode() for w in words])
        flat = np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))
        # Special tokens stand behind the words as words of one id.
        extra = np.unique(flat[flat < 0])
        starts = np.concatenate([np.cumsum(sizes) - sizes, len(ids) + np.arange(len(extra))])
        sizes = np.concatenate([sizes, np.ones(len(extra), np.int64)])
        ids = np.concatenate([ids, -1 - extra])
        at = np.where(flat < 0, len(words) + np.searchsorted(extra, flat), flat)
        counts = sizes[at]
        ends = np.cumsum(counts)
        out = ids[np.repeat(starts[at] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
        borders = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))
        return out.astype(np.uint32), np.diff(np.concatenate([[0], ends])[borders], prepend=0)


@lru_cache(maxsize=2)
def codec(path: str) -> BatchedBpe:
    return BatchedBpe(path)


def encode_texts(path: str):
    """A column function: the ids of a text as a list of int."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        ids, counts = codec(path).encode(["" if t is None else t for t in texts.to_pylist()])
        offsets = np.concatenate([[0], np.cumsum(counts)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))

    return encode


def decode_ids(path: str):
    """A column function: the text of a list of ids."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        table = codec(path).table
        return pa.array([table.decode(np.array(ids or [], np.int64)).tobytes().decode("utf-8", "replace") for ids in lists.to_pylist()], pa.string())

    return decode


def round_trip(path: str):
    """A column function: number and checksum of a text's ids, and the checksum of what they decode to."""

    @F.arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def digest(texts: pa.Array) -> pa.Array:
        coder, counts, of_ids, of_text = codec(path), [], [], []
        start = 0
        while start < len(texts):
            part, size = [], 0
            while start < len(texts) and size < 1_500_000:
                part.append(texts[start].as_py() or "")
                size += len(part[-1])
                start += 1
            ids, n = coder.encode(part)
            ends = np.cumsum(n)
            raw = coder.table.decode(ids)
            cuts = np.concatenate([[0], np.cumsum(coder.table.sizes[ids])])
            little = ids.astype("<u4")
            for a, b in zip((ends - n).tolist(), ends.tolist()):
                of_ids.append(hashlib.sha256(little[a:b]).hexdigest())
                text = raw[cuts[a]:cuts[b]].tobytes().decode("utf-8", "replace")
                of_text.append(hashlib.sha256(text.encode()).hexdigest())
            counts += n.tolist()
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digest


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts_of(documents(spark, sf_dir))
    return docs.select("doc_id", round_trip(vocabulary(BYTE_BPE))("text").alias("r")).select("doc_id", "r.*")

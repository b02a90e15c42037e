import hashlib
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from cases import frame, rows, words  # noqa: E402

from newsledger.llm import bpe, chunks, packing, shared, token_files  # noqa: E402
from newsledger.llm.shared import shared_path, texts_of  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def plain_ids(name, texts):
    tokenizer = Tokenizer.from_file(chunks.vocabulary(name))
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", [chunks.BYTE_BPE, chunks.WORD_BPE])
def test_chunks_encode_like_the_library(spark, name):
    texts = [t or "" for _, t in rows()] + [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    ids, counts = chunks.encoder(chunks.vocabulary(name)).encode(texts)
    ends = np.cumsum(counts)
    for want, a, b in zip(plain_ids(name, texts), ends - counts, ends):
        assert ids[a:b].tolist() == want


def test_merge_rounds_encode_and_decode_like_the_library():
    texts = [t or "" for _, t in rows()] + ["aaaaaaaaa bbbbb 00000", "don't we'll", "\x01 \x01\n", "a,b. c,\n.,."]
    path = chunks.vocabulary(chunks.BYTE_BPE)
    tokenizer, codec = Tokenizer.from_file(path), bpe.BatchedBpe(path, kept=3)
    for _ in range(2):
        ids, counts = codec.encode(texts)
        ends = np.cumsum(counts)
        for text, want, a, b in zip(texts, plain_ids(chunks.BYTE_BPE, texts), ends - counts, ends):
            assert ids[a:b].tolist() == want
            assert codec.table.decode(ids[a:b]).tobytes().decode("utf-8", "replace") == tokenizer.decode(want, skip_special_tokens=False) == text
    assert codec.table.decode(np.array([188, 50256])).tobytes().decode("utf-8", "replace") == tokenizer.decode([188, 50256], skip_special_tokens=False)


def test_bpe_columns(spark):
    path = chunks.vocabulary(chunks.BYTE_BPE)
    docs = texts_of(frame(spark))
    out = docs.select("text", bpe.round_trip(path)("text").alias("r"), bpe.decode_ids(path)(bpe.encode_texts(path)("text")).alias("back")).collect()
    for row, ids in zip(out, plain_ids(chunks.BYTE_BPE, [r.text for r in out])):
        assert row.back == row.text and row.r.n_tokens == len(ids)
        assert row.r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.r.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_token_files(spark):
    path = shared_path(spark, "test-files")
    token_files.write_token_files(frame(spark), path, chunks.vocabulary(chunks.BYTE_BPE))
    stored = token_files.read_tokens(spark, path)
    assert stored.filter("doc_id = 12").select("token_ids").first().token_ids == plain_ids(chunks.BYTE_BPE, [dict(rows())[12]])[0] + [2]
    got = sorted(token_files.digest(spark, path).collect(), key=lambda r: r.start)
    start, ids = 0, [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and len(ids) == len(rows())
    for row in got:
        assert row.start == start
        start += row.n_tokens
    want = sorted(zlib.crc32(np.array([*i, 2], "<u4").tobytes()) for i in plain_ids(chunks.BYTE_BPE, [t for _, t in rows()]))
    assert sorted(r.ids_crc32 for r in got) == want
    empty = shared_path(spark, "test-empty")
    token_files.write_token_files(frame(spark, []), empty, chunks.vocabulary(chunks.BYTE_BPE))
    assert token_files.digest(spark, empty).count() == 0


def test_token_files_layout(spark):
    import glob

    import pyarrow.parquet as pq

    path = shared_path(spark, "test-layout")
    token_files.write_token_files(spark.read.parquet(f"{SMALL}/documents.parquet"), path, chunks.vocabulary(chunks.BYTE_BPE))
    name = max(glob.glob(f"{path.removeprefix('file:')}/part-*"), key=lambda f: pq.ParquetFile(f).metadata.num_rows)
    columns = {c.path_in_schema: c for c in (pq.ParquetFile(name).metadata.row_group(0).column(i) for i in range(5))}
    ids = next(c for p, c in columns.items() if p.startswith("token_ids"))
    assert any("DICTIONARY" in e for e in ids.encodings) and ids.has_column_index and ids.has_offset_index
    assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings


@pytest.mark.parametrize("size", [64, 4096])
def test_packing(spark, size):
    docs = frame(spark)
    got = packing.pack(docs, chunks.vocabulary(chunks.WORD_BPE), size=size).collect()
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append([*plain_ids(chunks.WORD_BPE, [r.text])[0], 2])
    by_document, by_sequence = {}, {}
    for p in got:
        by_document.setdefault((p.doc_id, p.shard, p.row), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert len(by_document) == len(rows())
    for (doc_id, _, _), pieces in by_document.items():
        pieces.sort(key=lambda p: p.start)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        sums = [(p.length, p.ids_crc32) for p in pieces]
        fits = [[(p.length, zlib.crc32(np.array(t[p.start:p.start + p.length], "<u4").tobytes())) for p in pieces] for t in texts[doc_id] if len(t) == pieces[0].doc_tokens]
        assert sums in fits and sum(p.length for p in pieces) == pieces[0].doc_tokens
    for pieces in by_sequence.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) <= size
    assert len(by_sequence) * size - sum(p.length for p in got) < size
    assert packing.pack(frame(spark, []), chunks.vocabulary(chunks.WORD_BPE), size=size).count() == 0


def test_packing_keeps_two_small_tables_whatever_the_shuffle_partitions(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(packing, "stored", lambda df, name: made.setdefault(name, shared.stored(df, name)))
    texts = [words(k, 1 + 7 * k % 90) for k in range(160)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = packing.pack(frame(spark, list(enumerate(texts))).repartition(20), chunks.vocabulary(chunks.WORD_BPE), size=64).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    ids = plain_ids(chunks.WORD_BPE, texts)
    assert all(p.ids_crc32 == zlib.crc32(np.array((ids[p.doc_id] + [2])[p.start:p.start + p.length], "<u4").tobytes()) for p in got)
    assert any((p.start + p.length) % 64 and p.start + p.length < p.doc_tokens for p in got)
    assert sorted(made) == ["packing", "piece-counts"] and len(made["piece-counts"].inputFiles()) <= 2


def test_shortest_pack_first_takes_the_emptiest_pack():
    runs = packing.shortest_pack_first({6: 1, 5: 1, 3: 1, 1: 1}, 10)
    assert {(r[0], r[5]) for r in runs if r[0] in (6, 5)} == {(6, 0), (5, 1)}
    assert (3, 1) in {(r[0], r[5]) for r in runs}
    assert sum(r[4] * (r[2] - r[1]) for r in runs) == 15


def test_kept_pieces_are_bounded_and_change_no_id():
    texts = [words(seed, 200) + f" {seed * 7919} x{'y' * 60}{seed} café-{seed % 5}\n" for seed in range(120)]
    for name in (chunks.BYTE_BPE, chunks.WORD_BPE):
        small = (chunks.WordEncoder if name == chunks.WORD_BPE else chunks.ChunkEncoder)(chunks.vocabulary(name), 0)
        small.kept = 150
        whole, _ = chunks.encoder(chunks.vocabulary(name)).encode(texts)
        got, most = [], 0
        for text in texts:
            ids, _ = small.encode([text])
            got.append(ids)
            most = max(most, small.entries)
            assert len(small.index) == small.entries
        assert np.concatenate(got).tolist() == whole.tolist() and most < 600
        assert not any(len(k) > chunks.LONGEST for k in small.index)
        assert whole.tolist() == [i for t in texts for i in small.tokenizer.encode(t, add_special_tokens=False).ids]


def test_a_worker_keeps_one_model():
    first = chunks.encoder(chunks.vocabulary(chunks.BYTE_BPE))
    assert chunks.encoder(chunks.vocabulary(chunks.BYTE_BPE)) is first
    chunks.encoder(chunks.vocabulary(chunks.WORD_BPE))
    assert len(shared._kept) == 1 and chunks.encoder(chunks.vocabulary(chunks.BYTE_BPE)) is not first
    shared.release_worker()
    assert not shared._kept

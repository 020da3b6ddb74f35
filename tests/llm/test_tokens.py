"""Tokenizing, packing, token files and counts against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, models, pre_tokenizers

from quadrivium.llm import byte_bpe, elias_fano, token_files, unigram_counts
from quadrivium.llm.packing import best_fit_pack, pack_documents, plan_slots
from quadrivium.llm.token_ids import ByteLevelIds, WordIds

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANKS, PIECES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "\t", "a", "B", "the", "ing", "'s", "'ll", "'ve", "'", "!", "é", "1", "²", "中", "Σ", "́", "\U0001f642",
         "\xa0", "\x85", "\x1c", "<|", "|>", "▁", "<s>", "<0x41>"]
ODD = ["", " ", "\n\n", "'", "''s", "!'s", "\n's", "a" * 400, "ab" * 3000, " " * 900 + "x", "<|endoftext|> x", "Don't WE'LL  stop\n\n now "]


def texts(n, seed=1):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choices(PARTS, k=rnd.randrange(1, 30))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, length int, ids string")


@pytest.mark.parametrize("kind,path", [(ByteLevelIds, BYTES), (WordIds, WORDS)])
def test_chunked_ids_equal_the_library(kind, path):
    ids = kind(path)
    for t in texts(3000):
        assert np.frombuffer(ids.ids(t), "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_byte_bpe_equals_the_library_and_decodes():
    bpe = byte_bpe.Merges(RANKS)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    some = texts(4000)
    for t, ids in zip(some, bpe.encode(some)):
        assert memoryview(ids).cast("I").tolist() == lib.encode_ordinary(t), repr(t)
        assert bpe.decode(ids) == t.encode()
    ids = bpe.encode(["some words"])[0]
    assert bpe.offsets(ids).tolist()[0] == 0 and len(bpe.offsets(ids)) == len(ids) // 4


def test_byte_bpe_frames(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")]
    encoded = byte_bpe.encode_documents(frame(spark, rows), RANKS)
    decoded = byte_bpe.decode_documents(encoded, RANKS).collect()
    assert sorted(((r.doc_id or 0), bytes(r.decoded)) for r in decoded) == [(0, b"c"), (1, b""), (2, b""), (3, b"a b"), (3, b"a b")]
    assert byte_bpe.round_trip(frame(spark, []), RANKS).count() == 0


def unigram(pieces, fallback):
    lib = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lib


def test_counts_equal_the_library():
    pieces = unigram_counts.read_pieces(PIECES)
    small = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("aa", -2.0), ("b", -1.5), ("ab", -2.5), ("aab", -3.5), ("▁a", -3.0)]
    rnd = random.Random(2)
    ties = ["".join(rnd.choices("aabbé中 ", k=rnd.randrange(14))) for _ in range(3000)]
    for vocabulary, fallback, some in ((pieces, True, texts(2000)), (small, False, ties)):
        counter, lib = unigram_counts.UnigramCounter(vocabulary), unigram(vocabulary, fallback)
        for t in some:
            assert counter.count(t)[0] == len(lib.encode(t, add_special_tokens=False).ids), repr(t)


def test_count_frames(spark):
    got = unigram_counts.count_tokens(frame(spark, [(1, None), (2, ""), (3, "the end"), (None, "x")]), PIECES).collect()
    assert {r.doc_id: r.n_tokens > 0 for r in got} == {1: False, 2: False, 3: True, None: True}
    assert unigram_counts.count_tokens(frame(spark, []), PIECES).count() == 0


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5], list(range(1000)), [0, 2**50], sorted(random.Random(3).choices(range(10**9), k=3000)) + [10**9] * 700])
def test_elias_fano(values):
    data = elias_fano.encode(np.array(values, np.uint64), (values[-1] if values else 0) + 1)
    coded = elias_fano.EliasFano(b"xx" + data + b"yy", 2)
    assert coded.end == len(data) + 2 and coded.values().tolist() == values
    assert [coded.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        coded.select(len(values))


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000)).astype(np.uint64)
    assert len(elias_fano.encode(ends, int(ends[-1]) + 1)) * 8 / len(ends) < 2 + np.log2(1000) + 1.2


def test_token_files_round_trip(spark, scratch):
    rows = [(k * 7 - 50, t) for k, t in enumerate(texts(150))] + [(3, None), (3, "again again"), (None, "no id"), (2**60, "far")]
    got = token_files.round_trip(frame(spark, rows), WORDS, folder=scratch).collect()
    lib = Tokenizer.from_file(WORDS)
    want = {}
    for i, t in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_small_files_and_random_access(spark, scratch):
    rows = [(k, "word " * (k % 7)) for k in range(60)]
    files = token_files.write_token_files(frame(spark, rows), WORDS, scratch, task_bytes=400, file_ids=40)
    assert files.count() > 3 and files.agg({"n_docs": "sum"}).first()[0] == 60
    contents = spark.read.format("binaryFile").load(scratch + "/*.ids").select("content").collect()
    seen = {}
    for c in contents:
        f = token_files.TokenFile(bytes(c.content))
        for i in range(len(f)):
            seen[f.key(i)] = len(f.ids(i))
    assert seen == {k: k % 7 + 1 for k in range(60)}
    assert token_files.round_trip(frame(spark, []), WORDS, folder=scratch + "/none").count() == 0


def test_plan_places_everything_tightly():
    rnd = random.Random(5)
    counts = {}
    for _ in range(5000):
        n = min(64, int(rnd.expovariate(0.05)) + 1)
        counts[n] = counts.get(n, 0) + 1
    use, placed = {}, {}
    for length, lo, hi, first, offset in plan_slots(counts, 64):
        placed[length] = placed.get(length, 0) + hi - lo + 1
        for k in range(hi - lo + 1):
            use.setdefault(first + k, []).append((offset, length))
    assert placed == counts
    for items in use.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    assert len(use) <= -(-sum(k * v for k, v in counts.items()) // 64) * 1.02 + 1


def test_packing(spark):
    rows = [(k, "word " * (k * 37 % 300)) for k in range(120)] + [(500, None), (500, None), (None, "x")]
    got = pack_documents(frame(spark, rows), BYTES, max_len=64).collect()
    total = sum(r.length for r in got)
    pieces = {}
    for r in got:
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in pieces.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    assert len(pieces) <= -(-total // 64) * 1.05 + 1
    lib = Tokenizer.from_file(BYTES)
    for key, text in dict(rows).items():
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted({(r.start, r.length, r.ids_crc32) for r in got if r.doc_id == key})
        assert sum(n for _, n, _ in own) == len(ids) and all(n == 64 for _, n, _ in own[1:])
        assert [c for _, _, c in own] == [zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()) for s, n, _ in own]
    assert pack_documents(frame(spark, []), BYTES).count() == 0


def test_one_length_is_numbered_in_buckets(spark, monkeypatch):
    from quadrivium.llm import packing

    monkeypatch.setattr(packing, "RANK_ROWS", 10)
    pieces = spark.range(300).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "5L AS length", "id AS ids_crc32")
    got = best_fit_pack(pieces, 16).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 300 and len({r.sequence_id for r in got}) == 100


def test_very_long_texts(spark, scratch):
    long = "very long words and numbers 12345 éÀ " * 20_000
    rows = [(1, long), (2, "x" * 30_000), (3, None)]
    lib = Tokenizer.from_file(WORDS)
    got = {r.doc_id: r for r in token_files.round_trip(frame(spark, rows), WORDS, folder=scratch).collect()}
    for i, t in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        assert (got[i].n_tokens, got[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    ids = Tokenizer.from_file(BYTES).encode(long, add_special_tokens=False).ids + [2]
    own = [r for r in pack_documents(frame(spark, rows), BYTES).collect() if r.doc_id == 1]
    assert sum(r.length for r in own) == len(ids)
    assert {r.ids_crc32 for r in own} == {zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) for r in own}


@pytest.mark.parametrize("kind,path", [(ByteLevelIds, BYTES), (WordIds, WORDS)])
def test_latin_texts_are_cut_into_pieces_at_once(kind, path):
    ids, rnd = kind(path), random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "B", "the", "ing", "'s", "'LL", "'", "!", "é", "ß", "Ⱥ", "Ə", "ª", "×", "\xad", "1", "²", "½", "don't", "?!"]
    for _ in range(3000):
        t = "".join(rnd.choices(parts, k=rnd.randrange(1, 30)))
        assert np.frombuffer(ids.ids(t), "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
    assert not len(ids)  # no chunk was remembered beside its pieces

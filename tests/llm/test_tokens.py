"""Token counts, byte-level BPE and the token store against the libraries."""

import gc
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from shoplens.llm import bpe, token_counts, token_store
from tests.llm.conftest import ODD_TEXTS, table, words

WORD, BYTE, RANKS = (P.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))


def long_texts():
    rnd = random.Random(3)
    return [words(rnd, 900), words(rnd, 300) + "x" * 5000 + words(rnd, 50), "́" * 900 + " " + words(rnd, 200),
            "y" * 4000, words(rnd, 400, "AÉΣß<|>'t ") + " <|endoftext|>" * 300]


@pytest.mark.parametrize("chunk,overlap", [(200, 20), (1000, 64), (1 << 20, 512)])
def test_counts_equal_the_library(spark, chunk, overlap):
    texts = ODD_TEXTS + long_texts()
    tok = Tokenizer.from_file(WORD)
    got = {r.doc_id: r for r in token_counts.count_tokens(
        table(spark, texts), WORD, max_tokens=100, chunk_chars=chunk, overlap=overlap).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100), i


def test_counts_of_repeated_and_null_ids_and_no_rows(spark):
    long = long_texts()[0]
    size = len(long.encode())
    df = table(spark, [long, long, "a b", "a b", long], ids=[1, 1, None, 2, None])
    got = sorted((r.doc_id or -1, r.n_bytes) for r in token_counts.count_tokens(df, WORD, chunk_chars=200, overlap=20).collect())
    assert got == sorted([(1, size), (1, size), (-1, 3), (2, 3), (-1, size)])
    assert token_counts.count_tokens(df.limit(0), WORD).count() == 0


def reference_encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library(spark):
    ref = reference_encoding()
    texts = ODD_TEXTS + long_texts()
    got = {r.doc_id: r for r in bpe.encode_and_decode(table(spark, texts), RANKS, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = ref.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_random_strings():
    ref, enc = reference_encoding(), bpe.BytePairEncoder(bpe.read_ranks(RANKS))
    memo, pieces, rnd = bpe.PieceMemo(enc, limit=50), regex.compile(P.PATTERN), random.Random(1)
    for _ in range(3000):
        t = "".join(rnd.choice("aàeßñ 1\n\t.,'stmÜ你好абв😀́\x00\x1c\x85\xa0") for _ in range(rnd.randint(0, 40)))
        assert np.frombuffer(bpe.encode_text(t, pieces, memo), "<u4").tolist() == ref.encode_ordinary(t)
    assert len(memo) <= 50


def test_bpe_long_piece_is_linear():
    ref, enc = reference_encoding(), bpe.BytePairEncoder(bpe.read_ranks(RANKS))
    piece = "ab" * 50_000
    assert enc.encode(piece.encode()) == ref.encode_ordinary(piece)


def test_bpe_round_trip_of_tables(spark):
    texts = [t for t in ODD_TEXTS if t]
    ids = bpe.encode(table(spark, texts), RANKS, P.PATTERN)
    back = {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(ids, RANKS, P.PATTERN).collect()}
    assert back == dict(enumerate(texts))


@pytest.mark.parametrize("shard_ids,part_docs", [(1 << 20, 2000), (300, 4), (1, 1)])
def test_store_equals_the_library(spark, shard_ids, part_docs):
    texts = ODD_TEXTS + long_texts()
    rnd = random.Random(0)
    keys = rnd.sample(range(-1000, 1 << 40), len(texts))
    df = table(spark, texts, ids=keys)
    tok = Tokenizer.from_file(BYTE)
    store = token_store.write_store(df, BYTE, 2, shard_ids, part_docs)
    got = {r.doc_id: r for r in store.lookup(df).collect()}
    assert got == {r.doc_id: r for r in store.read_all().collect()}
    start = 0
    for key, t in sorted(zip(keys, texts)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[key].start, got[key].n_tokens) == (start, len(ids))
        assert got[key].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_store_null_repeated_and_foreign_keys(spark):
    df = table(spark, ["a", "b c", "d", "e"], ids=[None, 5, 5, 9])
    store = token_store.write_store(df, BYTE, 2)
    got = {r.doc_id: r for r in store.lookup(table(spark, [None] * 4, ids=[5, 7, 9, None])).collect()}
    assert set(got) == {None, 5, 9}
    assert got[5].n_tokens == len(Tokenizer.from_file(BYTE).encode("b c").ids) + 1 + 2
    assert (got[None].start, got[None].n_tokens) == (0, 2)
    empty = token_store.write_store(df.limit(0), BYTE, 2)
    assert empty.lookup(df).count() == empty.read_all().count() == 0


def test_store_cuts_shards_between_rows_of_one_key(spark):
    rnd = random.Random(7)
    texts = [words(rnd, 5) for _ in range(60)] + ["same"] * 20
    ids = [None if i % 2 else (7 if i % 4 else i) for i in range(len(texts))]
    tok = Tokenizer.from_file(BYTE)
    codes = [tok.encode(t).ids + [2] for t in texts]
    store = token_store.write_store(table(spark, texts, ids), BYTE, 2, shard_ids=40, part_docs=10)
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = store.read_all().collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(
        ((i, len(c), crc(c)) for i, c in zip(ids, codes)), key=key)
    assert max(r.n_ids for r in store.shards.select("n_ids").collect()) <= 40
    assert store.shards.where(f"min_key = {token_store.NULL_KEY}").select("part").distinct().count() > 1
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    seven = store.lookup(table(spark, ["", ""], [7, None])).where("doc_id = 7").collect()
    assert [r.n_tokens for r in seven] == [sum(len(c) for i, c in zip(ids, codes) if i == 7)]
    assert token_store.combined_crc(zlib.crc32(b"abcd"), zlib.crc32(b"efghijkl"), 8) == zlib.crc32(b"abcdefghijkl")


def test_units_are_encoded_independently():
    tok, rnd, coder = Tokenizer.from_file(BYTE), random.Random(2), token_store.TextCoder(BYTE, 2)
    assert coder.first.cut and coder.after_space.cut and token_counts._memo(WORD).cut
    for k in range(3000):
        t = "".join(rnd.choice("ab'st1 .\n\t\x0b\xa0\x1cé  " if k % 2 else "abTÉ×ß's.,| \nl") for _ in range(rnd.randint(0, 30)))
        assert b" ".join(token_store.units(t.encode())) == t.encode()
        ids = np.frombuffer(coder.encode(t.encode()), "<u2").tolist()
        assert ids == tok.encode(t, add_special_tokens=False).ids, t


def test_memos_are_no_work_for_the_collector(monkeypatch):
    """A worker collects garbage after each task; that must not go through all remembered words."""
    monkeypatch.setattr(token_store, "_WORKER", {})
    try:
        coder = token_store._coder(BYTE, 2)
        assert not any(x is coder.after_space or x is coder.first for x in gc.get_objects())
        assert token_store._coder(BYTE, 2) is coder
    finally:
        gc.unfreeze()


def test_word_memo_equals_the_library():
    rnd = random.Random(4)
    tok, memo = Tokenizer.from_file(WORD), token_counts._memo(WORD)
    for _ in range(5000):
        w = "".join(rnd.choice("abSTé×ÿßÀ'.,|1<>_Σǅ́") for _ in range(rnd.randint(1, 9)))
        assert memo[w.encode()] == len(tok.encode(w, add_special_tokens=False).ids), w


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 50, n, replace=False).astype(np.uint64)
    seeds = token_store.build_seeds(keys)
    assert sorted(token_store.slots_of(keys, seeds, n).tolist()) == list(range(n))

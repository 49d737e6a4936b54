"""Token files: codes, bit streams, whole-text equality of the ids, odd rows."""

import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratum.llm import token_files as K
from stratum.llm.common import new_path

FILE = public_tokenizers.path("word_bpe_49k.json")


def huffman_bits(counts):
    heap, total = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        n = heapq.heappop(heap) + heapq.heappop(heap)
        total += n
        heapq.heappush(heap, n)
    return total


@pytest.mark.parametrize("n, most", [(0, 18), (1, 18), (2, 18), (8, 3), (300, 18), (300, 9), (20_000, 18)])
def test_codes_round_trip(n, most):
    rng = np.random.default_rng(n)
    counts = np.zeros(n + 5, np.int64)
    counts[rng.permutation(n)] = np.maximum(1, 1e6 / np.arange(1, n + 1) ** 1.2).astype(int)
    lengths = K.code_lengths(counts, most)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max(initial=0) <= most
    if n > 1:
        assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() == 1
        bits = int((lengths * counts).sum())
        assert bits >= huffman_bits(counts) and (most < 18 or n > 300 or bits == huffman_bits(counts))
    ids = rng.choice(n + 5, 5000, p=counts / counts.sum()) if n else np.zeros(0, int)
    parts = [ids[:1000], ids[1000:1001], ids[1001:1257], ids[1257:]]
    codes = K.canonical(lengths)
    blocks = [(*K.encode_bits(p, lengths, codes), len(p)) for p in parts]
    for got, part in zip(K.Decoder(lengths)(blocks), parts):
        assert got.tolist() == part.tolist()


def test_too_many_ids_for_the_length():
    with pytest.raises(ValueError):
        K.code_lengths(np.ones(9, np.int64), 3)


ODD = [None, "", " ", "Hello, World!", "it's 'd x's... a,b ab,c d.e", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "\x1c a\x1db c d", "É é é , ́x", "日本語 テキスト。", "#$%, ,,, a!? B?!",
       "x" * 3000, "tab\tnew\nline\r\n", "I'LL WE'VE 123 45a6", "ǅ İ ß ΑΣ ΑΣ.", "a" * 5 + "." * 70, "\x00 ﻿ z"]


def test_ids_are_those_of_whole_texts(spark):
    rows = [(i if i % 5 else None, t, "clash") for i, t in enumerate(ODD * 2)] + [(100, "word " * 70_000, "c"), (7, "again seven", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(4)
    path = new_path(spark, "tokens-test")
    K.write_tokens(docs, path, FILE, end_id=2, vocabulary=49408)
    got = sorted((tuple(r) for r in K.read_tokens(spark, path).collect()), key=lambda r: r[1])
    tokenizer = Tokenizer.from_file(FILE)
    want = sorted(((d is not None, d or 0, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for d, t, _ in rows))
    assert sorted((d is not None, d or 0, bytes(i)) for d, _, _, i in got) == want
    assert [(d is not None, d or 0) for d, *_ in got] == [w[:2] for w in want]  # ascending, null first
    at = 0
    for _, start, n, ids in got:
        assert start == at and n * 4 == len(ids)
        at += n


def test_empty_table(spark):
    path = new_path(spark, "tokens-test")
    K.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), path, FILE, 2, 49408)
    assert K.read_tokens(spark, path).count() == 0


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer, at = Tokenizer.from_file(FILE), 0
    got = {r.doc_id: tuple(r) for r in K.op8_token_files(spark, sf).collect()}
    for d, t in sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert got.pop(d) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not got


def test_frequent_words_outlive_a_full_cache(monkeypatch):
    encoder = K.WordEncoder(FILE, np.uint16)
    learned, learn = [], encoder.cache.learn
    monkeypatch.setattr(K, "CACHE", 50)
    encoder.learn = encoder.cache.learn = lambda word: learned.append(word) or learn(word)
    tokenizer = Tokenizer.from_file(FILE)
    for i in range(300):
        text = f"often again, again w{i}x v{i}y. u{i}"
        got = np.frombuffer(encoder([text.encode()])[0], np.uint16)
        assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.cache) < 60 and len(encoder.cache.older) < 60
    assert learned.count(b"often") == learned.count(b"again") == 1

"""Ids against the tiktoken library on whole texts, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

from churnlens.llm import bpe_words as B
from churnlens.llm.queries import QUERIES, tokenizer_file

PATH = tokenizer_file("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("lib", pat_str=PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def test_packing():
    for x in ([], [0], [5, 70_000, 1 << 31, 0]):
        assert B.unpack_numbers(B.pack_numbers(np.array(x, np.int64))).tolist() == x
        assert B.unpack_rising(B.pack_rising(np.array(sorted(x), np.int64))).tolist() == sorted(x)
    for w in ([], [b""], [b"a", b"", "é\0".encode()]):
        assert B.unpack_words(B.pack_words(w)) == w


@pytest.mark.parametrize("block,bucket,long", [(B.BLOCK_BYTES, B.BUCKET_WORDS, B.LONG_TEXT), (300, 20, 50)])
def test_against_library(spark, library, monkeypatch, block, bucket, long):
    monkeypatch.setattr(B, "LONG_TEXT", long)
    rng = random.Random(6)
    texts = ["", None, " ", "a", "don't  stop\t\n now ", "日本語 ñ\0b", "x" * 3000, "the " * 900, "<|endoftext|>", "\n\n\n"]
    texts += ["".join(rng.choices(["the", " ", "é", "1", "!", "\n", "'s", "日"], k=rng.randrange(200))) for _ in range(40)]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(None, "no id", "c"), (3, "a", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = B.decode(B.encode(df, PATH, PATTERN, block_bytes=block, bucket_words=bucket), PATH).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    assert sorted(((r.doc_id, r.ids, bytes(r.bytes)) for r in got), key=str) == sorted(want, key=str)
    both = B.encode(df, PATH, PATTERN, block_bytes=block, bucket_words=bucket, decoded=True).collect()
    assert sorted(((r.doc_id, r.ids, bytes(r.bytes)) for r in both), key=str) == sorted(want, key=str)


def test_empty_and_unknown(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.encode(df, PATH, PATTERN).count() == 0
    odd = spark.createDataFrame([(1, [10**6]), (2, None), (3, [None]), (4, [-1]), (5, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.bytes for r in B.decode(odd, PATH).collect()} == {1: None, 2: None, 3: None, 4: None, 5: b""}


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    got = {r.doc_id: r for r in QUERIES["op8_byte_bpe"](spark, sf).collect()}
    for i, text in zip(t["doc_id"], t["text"]):
        ids = library.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()

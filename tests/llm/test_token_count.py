"""Token counts: chunked encoding equals encoding the whole text."""

import random

import pytest

from churnlens.llm.queries import tokenizer_file
from churnlens.llm.token_count import TokenizerFile, chunked_ids, count_tokens, part_counts

TEXTS = ["", "a", "word " * 3000, "x" * 5000, "  \n\n " * 700, "don't  stop\tnow " * 400, "é" * 3000 + " ok " * 300,
         "日本語 text 123 " * 500, "a<|endoftext|>b " * 300, "!!! ??? " * 500, "one two three\n" * 500, "A1 b2" * 900]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_chunks_equal_whole(name):
    tok = TokenizerFile(tokenizer_file(name))
    rng = random.Random(5)
    mixed = ["".join(rng.choice(TEXTS)[:rng.randrange(1, 300)] + rng.choice(["", " ", "\n", "  "])
                     for _ in range(60)) for _ in range(6)]
    for text in TEXTS + mixed:
        whole = tok.offsets(text).ids
        assert len(whole) == (tok.counts([text])[0] if text else 0)
        for chunk, overlap in ((64, 8), (300, 32), (1000, 64)):
            if name.endswith(".model") and text != " ".join(text.split()):
                continue  # white space is rewritten at a chunk's start there; checked on plain texts only
            assert chunked_ids(text, tok.offsets, chunk, overlap) == whole


def test_rows(spark):
    tok = TokenizerFile(tokenizer_file("byte_bpe_50k.json"))
    rows = [(1, None, "x"), (2, "", "y"), (None, "hello there", "z"), (3, "hé " * 900, "z"), (3, "hé " * 900, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
           for r in count_tokens(df, tokenizer_file("byte_bpe_50k.json"), chunk=100, overlap=16).collect()}
    n = tok.counts(["hé " * 900])[0]
    assert got == {(1, 0, 0, False), (2, 0, 0, False), (None, 11, 2, False), (3, 3600, n, n > 512)}
    assert count_tokens(df, tokenizer_file("byte_bpe_50k.json")).count() == 5
    assert count_tokens(df.limit(0), tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_long_texts_with_any_white_space_in_a_sentencepiece_file(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    tok, rng = TokenizerFile(path), random.Random(8)
    mixed = ["".join(rng.choice(TEXTS)[:rng.randrange(1, 300)] + rng.choice(["", " ", "\n", "  "])
                     for _ in range(60)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate([*TEXTS, *mixed]) if t]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk, overlap in ((64, 8), (300, 32), (1000, 64)):
        got = {r.doc_id: r.n_tokens for r in count_tokens(df, path, chunk=chunk, overlap=overlap).collect()}
        assert got == {i: tok.counts([t])[0] for i, t in rows}


@pytest.mark.parametrize("between", ["\n", "。", ""])
def test_texts_without_blanks_are_encoded_about_once(between):
    tok, rng = TokenizerFile(tokenizer_file("byte_bpe_50k.json")), random.Random(4)
    text = between.join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(rng.randrange(5, 60))) for _ in range(30_000))
    text = text[:1_000_000 if between else 200_000]
    seen = [0]

    def encode(part):
        seen[0] += len(part)
        return tok.offsets(part)
    assert chunked_ids(text, encode) == tok.offsets(text).ids
    assert seen[0] < (1.5 if between else 3) * len(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_parts_count_as_whole_texts(name):
    tok, rng = TokenizerFile(tokenizer_file(name)), random.Random(6)
    odd = [" ", "  a", "a ", "\x1c x", "x \u180e y", "\u180e z", "a\u00a0 b", "a \u3000 b", "\u200b \u200b", "e\u0301 \u0301e", "<|endoftext|> <|endoftext|>x",
           "don't 's 's", "\ufb01 \u1e9b\u0323 \u212b", "tab\t x\n y", "\x85 a \x85"]
    mixed = ["".join(rng.choice(odd + [t for t in TEXTS if t])[:rng.randrange(1, 40)] + rng.choice(["", " ", "\n"]) for _ in range(30)) for _ in range(60)]
    texts = [t for t in TEXTS + odd + mixed if t]
    assert part_counts(texts, tok.counts).tolist() == tok.counts(texts)

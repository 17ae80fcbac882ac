"""Registered queries over whole small tables: columns, types and values against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest

from churnlens.llm import simhash
from churnlens.llm.common import read_table
from churnlens.llm.queries import QUERIES, tokenizer_file
from test_fuzzy_lines import brute as brute_lines
from test_simhash import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]


def test_op4(spark):
    got = QUERIES["op4_html_text"](spark, SF)
    assert got.dtypes[:4] == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    pages = {r.page_id: r.url for r in read_table(spark, SF, "pages").collect()}
    rows = got.collect()
    assert {r.page_id: r.url for r in rows} == pages and len(rows) == len(pages)
    assert all(r.n_chars == len(r.text) and "<p" not in r.text for r in rows) and any(r.n_chars for r in rows)


def test_op5(spark, documents):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    got = QUERIES["op5_token_counts"](spark, SF)
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = []
    for i, t in documents:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(want)


def test_op6(spark, documents):
    texts = [(i, (t or "").encode()) for i, t in documents]
    seen = Counter(t[a:a + 400] for _, t in texts for a in range(len(t) - 399))
    want = []
    for i, t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - 399):
            if seen[t[a:a + 400]] > 1:
                gone[a:a + 400] = b"\x01" * 400
        spans = sum(1 for a in range(len(t)) if gone[a] and (a == 0 or not gone[a - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        want.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = QUERIES["op6_suffix_dedup"](spark, SF)
    assert got.dtypes[:5] == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"),
                              ("kept_sha256", "string")]
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted(want)
    assert any(w[2] for w in want)


def test_op9(spark, documents):
    ids = [i for i, _ in documents]
    prints = [simhash.fingerprint((t or "").encode()) for _, t in documents]
    comp = brute_components(prints, ids, 3)
    got = QUERIES["op9_simhash"](spark, SF)
    assert got.dtypes[:3] == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, comp))


def test_op10(spark, documents):
    want = defaultdict(list)
    for (i, t), gone in brute_lines(documents).items():
        want[i].append((sum(bool(x.strip()) for x in (t or "").split("\n")), len(gone)))
    got = QUERIES["op10_fuzzy_lines"](spark, SF)
    assert got.dtypes[:3] == [("doc_id", "bigint"), ("n_lines", "bigint"), ("n_removed", "bigint")]
    rows = got.collect()
    assert len(rows) == len(documents) and all((r.n_lines, r.n_removed) in want[r.doc_id] for r in rows)

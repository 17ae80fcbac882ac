"""Window hits against a plain scan over words."""

import random

import pytest

from churnlens.llm.decontaminate import Matcher, decontaminate, words


def brute(text, items, size):
    w, hit, found = words((text or "").encode()), set(), set()
    for name, item in items:
        iw = words((item or "").encode())
        n = min(size, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(name)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("pattern_bytes", [1 << 20, 40])
def test_against_brute_force(spark, pattern_bytes):
    rng = random.Random(2)
    vocab = ["a", "B", "é", "ab", "7", "x-y", "c"]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randrange(0, 9)))) for k in range(12)] + [(12, None), (13, "--"), (13, "A b")]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, k=rng.randrange(0, 60))), "z") for i in range(60)]
    docs += [(100, None, ""), (101, "", ""), (None, "a b", ""), (1, docs[1][1], "z")]
    d = spark.createDataFrame(docs, "doc_id long, text string, items string")
    b = spark.createDataFrame(items, "item_id int, text string")
    got = decontaminate(d, b, window=4, pattern_bytes=pattern_bytes).collect()
    want = [(i, *brute(t, items, 4)) for i, t, _ in docs]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, sorted(set(r["items"]))) for r in got), key=str) == sorted(want, key=str)
    texts = {i: t for i, t, _ in docs}
    for r in got:
        if r.doc_id is not None and r.doc_id < 100:  # the places in the original hold exactly the hit words
            raw = (texts[r.doc_id] or "").encode()
            assert sum(len(words(raw[s.start:s.end])) for s in r.spans) == r.n_hit


def test_no_items_and_no_rows(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    assert [tuple(r) for r in decontaminate(d, none).collect()] == [(1, 2, 0, [], [])]
    assert decontaminate(d.limit(0), none).count() == 0


def test_repeated_window_in_long_text():
    m = Matcher([(7, "one two three")], 10)
    n, ranges, items = m.scan(("one, two THREE! " * 5000).encode())
    assert n == 15000 and len(ranges) == 5000 and items == {0}

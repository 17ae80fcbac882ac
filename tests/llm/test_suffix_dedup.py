"""Removed passages against a table of all windows; suffix order and neighbours against plain code."""

import random
from collections import defaultdict

import numpy as np
import pytest

from churnlens.llm import suffix_dedup as S


def brute(rows, window, keep_first):
    """Removed spans per row; rows: (id, text)."""
    at = defaultdict(list)
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0))
    for n, r in enumerate(order):
        b = (rows[r][1] or "").encode()
        for i in range(len(b) - window + 1):
            at[b[i:i + window]].append((n, i))
    gone = defaultdict(set)
    for places in at.values():
        for k, (n, i) in enumerate(places):
            if len(places) > 1 and (k or not keep_first):
                gone[order[n]].update(range(i, i + window))
    out = []
    for r, (name, text) in enumerate(rows):
        b, s = (text or "").encode(), sorted(gone[r])
        spans = []
        for i in s:
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((name, len(b), spans, bytes(x for i, x in enumerate(b) if i not in gone[r])))
    return out


def texts(seed, n, size):
    rng = random.Random(seed)
    rand = lambda m: "".join(rng.choices("abcdé ", k=m))
    shared = [rand(rng.randrange(20, size)) for _ in range(6)]
    out = []
    for _ in range(n):
        t = "".join(rng.choice([rand(rng.randrange(0, 60)), rng.choice(shared), rng.choice(shared)[rng.randrange(15):]])
                    for _ in range(rng.randrange(0, 7)))
        if t and rng.random() < 0.4:
            p = rng.randrange(len(t))
            t = t[:p] + rng.choice("abcd") + t[p + 1:]
        out.append(t)
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("most", [S.MOST_STRETCHES, 3])
def test_against_all_windows(spark, monkeypatch, keep_first, most):
    monkeypatch.setattr(S, "PIECE", 97)
    monkeypatch.setattr(S, "BATCH_BYTES", 700)
    rows = [(i + 1, t) for i, t in enumerate(texts(7, 60, 150))]
    rows += [(70, None), (71, ""), (72, "a" * 300), (73, "ab" * 150), (74, "x" * 39), (75, "x" * 40), (76, "x" * 41),
             (77, rows[3][1] + rows[4][1]), (78, "a" * 300), (None, rows[5][1] + "tail " * 12), (80, "abc" * 60 + "d" + "abc" * 60)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, spans string")
    got = S.remove_passages(df, window=40, reach=24, gram=8, keep_first=keep_first, most=most).collect()
    got = sorted(((r.doc_id, r.n_bytes, [list(s) for s in r.spans], bytes(r.kept)) for r in got), key=str)
    want = sorted(brute(rows, 40, keep_first), key=str)
    for a, b in zip(got, want):
        assert a == b
    assert len(got) == len(want)


def test_production_window(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passage = say(160)
    rows = [(i, say(rng.randrange(1, 200)) + (passage[rng.randrange(80):] if i % 3 else "") + say(rng.randrange(100))) for i in range(30)]
    rows += [(40, rows[4][1]), (41, rows[4][1][1:]), (42, rows[4][1] * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, [list(s) for s in r.spans], bytes(r.kept)) for r in S.remove_passages(df, keep_first=False).collect())
    assert got == sorted(brute(rows, 400, False))


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abcdefgh" * 8 + "0123456789"), (1, "abcdefgh" * 8 + "0123456789"), (2, "q" * 10)], "doc_id long, text string")
    got = S.remove_passages(df, window=60, reach=24, gram=8, keep_first=False).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in got) == [(1, b""), (1, b""), (2, b"q" * 10)]
    got = S.remove_passages(df.unionAll(df.selectExpr("doc_id + 5", "text || '!'")), window=60, reach=24, gram=8).collect()
    assert sorted((r.doc_id, len(r.kept)) for r in got) == [(1, 74), (1, 74), (2, 10), (6, 1), (6, 1), (7, 11)]
    named = S.remove_passages(df.selectExpr("cast(doc_id as string) doc_id", "text"), window=60, reach=24, gram=8)
    assert sorted((r.doc_id, len(r.kept)) for r in named.collect()) == [("1", 74), ("1", 74), ("2", 10)]
    assert S.remove_passages(df.limit(0)).count() == 0


@pytest.mark.parametrize("window", [1, 3, 8, 13, 20])
def test_suffix_order_and_neighbours(window):
    rng = np.random.default_rng(window)
    x = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(0, 400 - window + 1, 2)
    order, group = S.suffix_order(x, starts, window)
    pre = [x[s:s + window].tobytes() for s in starts]
    assert [pre[i] for i in order] == sorted(pre)
    assert all((pre[order[k]] == pre[order[k - 1]]) == (group[k] == group[k - 1]) for k in range(1, len(order)))
    place = rng.permutation(len(starts))
    value = place[order]
    want = [max((j for j in range(i) if group[j] == group[i] and value[j] < value[i]), default=-1) for i in range(len(order))]
    assert S.nearest_before(value, group).tolist() == want
    earlier, later = S.matches(x, starts, place, window)
    for i, p in enumerate(pre):
        assert earlier[i] == any(q == p and place[j] < place[i] for j, q in enumerate(pre))
        assert later[i] == any(q == p and place[j] > place[i] for j, q in enumerate(pre))

"""Fingerprints and components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from churnlens.llm import simhash as S


def brute_print(text, size):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    s = [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def brute_components(fps, ids, bits):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(fps))]


def test_fingerprint(monkeypatch):
    rng = random.Random(1)
    texts = ["", " \t\n", "One", "one two", "One TWO three É", "a b c d " * 50, "x\x0by\x0cz\x1cw q r s"]
    texts += [" ".join(rng.choices("ab cd Ef gh é".split(), k=rng.randrange(1, 40))) for _ in range(30)]
    want = [brute_print(t, 3) for t in texts]
    assert [S.fingerprint(t.encode()) for t in texts] == want
    monkeypatch.setattr(S, "SHINGLE_BLOCK", 7)
    assert [S.fingerprint(t.encode()) for t in texts] == want


def test_allocation_is_least():
    costs = [[0, 5, 6, 30, 90], [0, 1, 50, 60, 90], [0, 2, 9, 10, 90]]
    cost, ts = S.allocate(costs, 3)
    every = [(sum(c[t + 1] for c, t in zip(costs, (a, b, c2))), (a, b, c2)) for a in range(-1, 4) for b in range(-1, 4)
             for c2 in range(-1, 4) if a + b + c2 + 3 == 4]
    assert cost == min(every)[0] and sum(t + 1 for t in ts) == 4


def test_plan_is_complete():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (500, 64))
    x[:, 1::2] = x[:, ::2]  # every second bit copies its neighbour
    both = (x.T @ x).astype(float)
    for n in (500, 10**6, 10**10):
        parts = S.plan(n, both * (n / 500), 3)
        bits = [b for g, _ in parts for b in g]
        assert len(bits) == len(set(bits)) and sum(t + 1 for _, t in parts) == 4
    groups = S.group_bits(S.agreement(500, both), 4)
    assert sum((b ^ 1) in g for g in groups for b in g) >= 60  # bits that go together stand together


@pytest.mark.parametrize("bucket", [S.BUCKET, 40])
def test_components_against_all_pairs(spark, bucket):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = [0, 0xFFFFFFFFFFFFFFFF]
    for _ in range(260):
        f = rng.choice(centres)
        for _ in range(rng.randrange(0, 5)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "_fp long")
    for bits in ((3,) if bucket < 100 else (1, 3)):
        from churnlens.llm.components import components
        got = {r.node: r.component for r in components(S.links(df, bits, bucket)).collect()}
        sign = [S._signed(f) for f in fps]
        want = brute_components(fps, sign, bits)
        assert [got.get(s, s) for s in sign] == want


def test_large_buckets_of_a_partition_with_a_threshold(spark, monkeypatch):
    fps = sorted({a ^ b << 30 for a in range(0, 64, 3) for b in (0, 1, 5, 9, 1 << 20)})
    monkeypatch.setattr(S, "plan", lambda *_: [(list(range(32)), 2), (list(range(32, 64)), 0)])
    df = spark.createDataFrame([(f,) for f in fps], "_fp long")
    from churnlens.llm.components import components
    got = {r.node: r.component for r in components(S.links(df, 3, 20)).collect()}
    assert [got.get(f, f) for f in fps] == brute_components(fps, fps, 3)


def test_rows(spark):
    text = "a quick test of words that go on and on"
    rows = [(5, text, "x"), (3, text.upper(), "x"), (4, text, "x"), (4, text, "x"), (9, None, "y"), (8, "", "y"),
            (None, text, "y"), (1, "unlike in all of its words", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.simhash_dedup(df).collect()), key=str)
    fps = [brute_print(t, 3) for _, t, _ in rows]
    want = brute_components(fps, [r[0] for r in rows], 3)
    assert got == sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, want)), key=str)
    assert S.simhash_dedup(df.limit(0)).count() == 0
    only = spark.createDataFrame([(None, "p q r")], "doc_id long, text string")
    assert S.simhash_dedup(only).first()["component_id"] is None

"""Links, counts and components against the full matrix."""

import math

import numpy as np
import pytest

from churnlens.llm.embedding_join import embedding_dedup, join_block


def brute(rows, threshold):
    ok = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, (_, v) in enumerate(rows)
          if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    near = {i: [j for j in ok if j != i and len(ok[j]) == len(ok[i]) and ok[i] @ ok[j] >= threshold] for i in ok}
    out = []
    for i, (name, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        names = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(names, default=None)
        out.append((name, len(near.get(i, [])), low, name is not None and name == low))
    return out


def cloud(seed, n, dim, spread):
    r = np.random.default_rng(seed)
    c = r.normal(size=(9, dim))
    return [[float(x) for x in (c[r.integers(9)] + spread * r.normal(size=dim))] for _ in range(n)]


@pytest.mark.parametrize("block,threshold", [(6144, 0.95), (16, 0.9), (7, 0.8)])
def test_against_all_pairs(spark, block, threshold):
    vecs = cloud(1, 150, 6, 0.4)
    vecs += [vecs[3], vecs[3], [2 * x for x in vecs[5]], None, [], [0.0] * 6, [1.0, None, 1.0, 1.0, 1.0, 1.0], [math.nan] * 6,
             [math.inf] + [1.0] * 5, [1.0, 1.0], [1.0, 0.99], [-0.0, 1.0], [0.0, 1.0], [1e200] * 6, [1e-200] * 6]
    rows = [(1000 - i, v) for i, v in enumerate(vecs)] + [(None, vecs[7]), (None, None), (1000, vecs[0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n_links string")
    got = [tuple(r) for r in embedding_dedup(df, threshold=threshold, block=block, most_pivots=9).collect()]
    rows = [(i, [x / 1e200 for x in v] if v and v[0] == 1e200 else [x * 1e200 for x in v] if v and v[0] == 1e-200 else v) for i, v in rows]
    assert sorted(got, key=str) == sorted(brute(rows, threshold), key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup(df).count() == 0


def test_block_counts_each_pair_once():
    v = np.array([[1.0, 0], [1, 0], [0, 1], [1, 0]])
    w = np.array([1, 2, 3, 4])
    count, forest = join_block(v[:3], v[3:], w, 0.9, among=True)
    assert count.tolist() == [6, 5, 0, 3] and len(forest) == 2
    count, forest = join_block(v[:3], v[3:], w, 0.9, among=False)
    assert count.tolist() == [4, 4, 0, 3] and len(forest) == 2

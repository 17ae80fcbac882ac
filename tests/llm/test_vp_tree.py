"""Nearest neighbours against all products; recall and work of relaxed pruning."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm.vp_tree import Tree, build_index, nearest, products


def ordered(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += x * y
    return s + 0.0


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, k, asks):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and usable(v)})
    out = []
    for i, v in rows:
        if asks(i):
            near = sorted((-ordered(v, w), j) for j, w in rows if len(w) == len(v) and (j, w) != (i, v))[:k]
            out += [(i, r + 1, j, -s + 0.0) for r, (s, j) in enumerate(near)]
    return out


def cloud(seed, n, dim):
    r = np.random.default_rng(seed)
    c = r.normal(size=(7, dim))
    return [[float(x) for x in (c[r.integers(7)] + 0.3 * r.normal(size=dim)) * r.uniform(0.2, 3)] for _ in range(n)]


@pytest.mark.parametrize("k,shard,block,leaf", [(20, 8192, 2048, 64), (5, 40, 7, 4), (30, 16, 50, 2)])
def test_exact_with_odd_rows(spark, k, shard, block, leaf):
    vecs = cloud(1, 150, 6)
    vecs += [vecs[3]] * 40 + [vecs[9], None, [], [0.0] * 6, [1.0, None, 1.0, 1.0, 1.0, 1.0], [math.nan] * 6,
                              [math.inf] + [1.0] * 5, [1.0, 2.0], [1.0, 0.5], [-1.0, 0.0], [2.0, 4.0]]
    rows = [(300 - i, v) for i, v in enumerate(vecs)] + [(300, vecs[0]), (298, vecs[2]), (290, [9.0] * 6), (None, vecs[7]), (None, None)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, rank string, _key int")
    got = nearest(df.repartition(5), where=F.col("vec_id") % 3 == 0, k=k, shard=shard, block=block, leaf=leaf)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, k, lambda i: i % 3 == 0))


def test_overflowing_products(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [-1e200, 0.0]), (3, [1e-200, 1e-200]), (4, [1.0, 1.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=4)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 4, lambda i: True))


def test_empty_table_and_no_queries(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest(spark.createDataFrame([], schema)).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema), where=F.col("vec_id") > 5).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0])], schema)).count() == 0


def test_every_vector_is_indexed(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cloud(2, 200, 5))], "vec_id string, embedding array<double>")
    _, index = build_index(df, shard=30)
    held = index.select(F.explode(F.flatten("_lists")).alias("id")).collect()
    assert sorted(int(r.id) for r in held) == list(range(200)) and index.count() > 3


def test_factor_prunes_and_recall_stays():
    x = np.array(cloud(3, 4000, 8))
    q = x[::20]
    tree = Tree(x, 32)
    assert sorted(tree.order.tolist()) == list(range(4000))
    want = np.sort(q @ x.T, axis=1)[:, ::-1][:, :20]
    made = []
    for factor, least in ((1.0, 1.0), (1.3, 0.95)):
        score, _, n = tree.search(q, 20, factor)
        made.append(n)
        assert (score >= want[:, -1:] - 1e-9).mean() >= least
    assert made[1] < 0.4 * made[0] < 0.4 * len(q) * len(x)


def test_products_add_in_order():
    r = np.random.default_rng(0)
    a, b = r.normal(size=(50, 33)), r.normal(size=(50, 33))
    assert products(a, b).tolist() == [ordered(x, y) for x, y in zip(a.tolist(), b.tolist())]


def test_registered_query(spark, tmp_path):
    from churnlens.llm.queries import QUERIES
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(cloud(4, 120, 6))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op11_vp_tree"](spark, str(tmp_path))
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 20, lambda i: i % 20 == 0))

"""Graph operators against brute force on small graphs."""

from collections import deque

import numpy as np
import pytest

from churnlens.operators import graph as G


def brandes(nodes, edges, sources):
    adj = {n: [] for n in nodes}
    for s, d in edges:
        adj[s].append(d)
    bc = dict.fromkeys(nodes, 0.0)
    for s in sources:
        dist, sigma, preds, order = {s: 0}, dict.fromkeys(nodes, 0.0), {n: [] for n in nodes}, []
        sigma[s] = 1.0
        q = deque([s])
        while q:
            v = q.popleft()
            order.append(v)
            for w in adj[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    q.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    preds[w].append(v)
        delta = dict.fromkeys(nodes, 0.0)
        for w in reversed(order):
            for v in preds[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    return bc


def _graph(spark, names, edges, followers=None):
    nodes = spark.createDataFrame([(n, 0, (followers or {}).get(n, 0), 1, 1) for n in names],
                                  "username string, churn int, followers long, following long, repos long")
    e = spark.createDataFrame(edges, "src string, dst string")
    return nodes, e


EDGES = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("e", "f"), ("b", "e"), ("f", "a"), ("c", "f")]
NAMES = list("abcdefg")


def test_betweenness_all_sources(spark):
    nodes, e = _graph(spark, NAMES, EDGES)
    got = {r["username"]: r["betweenness_centrality"] for r in G.betweenness(nodes, e, k=len(NAMES)).collect()}
    bf = brandes(NAMES, EDGES, NAMES)
    n = len(NAMES)
    for v in NAMES:
        assert got[v] == pytest.approx(bf[v] / ((n - 1) * (n - 2)))


def test_betweenness_sampled_sources(spark):
    nodes, e = _graph(spark, NAMES, EDGES)
    src = [r["source"] for r in G.sample_sources(nodes, 3).collect()]
    got = {r["username"]: r["betweenness_centrality"] for r in G.betweenness(nodes, e, k=3).collect()}
    bf = brandes(NAMES, EDGES, src)
    n = len(NAMES)
    for v in NAMES:
        assert got[v] == pytest.approx(bf[v] / ((n - 1) * (n - 2)) * n / 3)


def test_pagerank_matches_power_iteration(spark):
    nodes, e = _graph(spark, NAMES, EDGES)
    got = {r["username"]: r["pagerank"] for r in G.pagerank(nodes, e, tol=None, max_iter=60).collect()}
    idx = {v: i for i, v in enumerate(NAMES)}
    n = len(NAMES)
    A = np.zeros((n, n))
    for s, d in EDGES:
        A[idx[s], idx[d]] = 1
    out = A.sum(1)
    x = np.full(n, 1 / n)
    for _ in range(60):
        dang = x[out == 0].sum()
        x = 0.85 * (x / np.where(out > 0, out, 1)) @ A + 0.85 * dang / n + 0.15 / n
    for v in NAMES:
        assert got[v] == pytest.approx(x[idx[v]], abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)


def test_proxy_edges_rules(spark):
    rows = [("hub0", 0, 100, 0, 1), ("hub1", 0, 90, 2, 1), ("hub2", 0, 80, 9, 1), ("u", 1, 1, 3, 1),
            ("iso", 0, 0, 0, 1)]
    nodes = spark.createDataFrame(rows, "username string, churn int, followers long, following long, repos long")
    e = sorted((r["src"], r["dst"]) for r in G.follow_edges(nodes, hubs=5, skip_top=1).collect())
    # rank 0 (hub0) is skipped; hub1 does not point at itself; iso (following 0) has no out-edges
    assert ("u", "hub1") in e and ("u", "hub2") in e and ("u", "u") not in e
    assert not any(s == "iso" for s, _ in e) and not any(d == "hub0" for _, d in e)
    assert ("hub1", "hub1") not in e and ("hub1", "hub2") in e
    deg = {r["username"]: r["degree_centrality"] for r in G.degree_centrality(nodes, spark.createDataFrame(e, "src string, dst string")).collect()}
    iso_in = sum(1 for _, d in e if d == "iso")
    assert deg["iso"] == pytest.approx(iso_in / 4)      # centrality from in-edges only


def test_density(spark):
    nodes, e = _graph(spark, NAMES, EDGES)
    r = G.graph_density(nodes, e).first()
    assert r["density"] == pytest.approx(len(EDGES) / (7 * 6))


def test_pagerank_salted_hot_source(spark):
    names = [f"n{i}" for i in range(40)]
    edges = [("n0", f"n{i}") for i in range(1, 40)] + [(f"n{i}", "n0") for i in range(1, 20)] + [("n5", "n6")]
    nodes, e = _graph(spark, names, edges)
    plain = {r["username"]: r["pagerank"] for r in
             G.pagerank(nodes, e, tol=None, max_iter=40, fair_share=10**9).collect()}
    salted = {r["username"]: r["pagerank"] for r in
              G.pagerank(nodes, e, tol=None, max_iter=40, fair_share=4).collect()}
    for v in names:
        assert salted[v] == pytest.approx(plain[v], abs=1e-14)
    assert sum(salted.values()) == pytest.approx(1.0)


def test_pagerank_raises_without_convergence(spark):
    nodes, e = _graph(spark, NAMES, EDGES)
    with pytest.raises(RuntimeError, match="converge"):
        G.pagerank(nodes, e, max_iter=1)
    got = G.pagerank(nodes, e)
    assert got.agg({"pagerank": "sum"}).first()[0] == pytest.approx(1.0)


def test_betweenness_of_a_long_chain(spark):
    names = [f"c{i}" for i in range(7)]
    edges = [(names[i], names[i + 1]) for i in range(6)]
    nodes, e = _graph(spark, names, edges)
    got = {r["username"]: r["betweenness_centrality"] for r in G.betweenness(nodes, e, k=7).collect()}
    assert got == {names[i]: pytest.approx(i * (6 - i) / 30) for i in range(7)}


def test_subgraph_of_given_nodes(spark):
    nodes, e = _graph(spark, NAMES, EDGES)
    keep = nodes.limit(4)
    names = {r["username"] for r in keep.collect()}
    n, sub = G.subgraph(nodes, e, spark.createDataFrame([(x,) for x in names], "username string"))
    assert {r["username"] for r in n.collect()} == names
    assert {tuple(r) for r in sub.collect()} == {(a, b) for a, b in EDGES if a in names and b in names}


def test_hub_targets_lie_in_many_blocks(spark):
    leaves = [f"l{i}" for i in range(3000)]
    names = ["hub", *leaves, "end"]
    edges = [("hub", x) for x in leaves] + [(x, "end") for x in leaves[:50]] + [("end", "hub")]
    nodes, e = _graph(spark, names, edges)
    g = G.adjacency(nodes, e, block=100)
    sizes = [r["n"] for r in g.blocks.selectExpr("size(targets) as n").collect()]
    assert sum(sizes) == len(edges) and max(sizes) < 150 and len(sizes) > 30
    src = [r["source"] for r in G.sample_sources(nodes, 70).collect()]  # more than one group of sources
    got = {r["username"]: r["betweenness_centrality"] for r in G.betweenness(nodes, e, k=70, graph=g).collect()}
    bf, n = brandes(names, edges, src), len(names)
    for v in names:
        assert got[v] == pytest.approx(bf[v] / ((n - 1) * (n - 2)) * n / 70)


def test_repeated_edges_and_empty_graph(spark):
    nodes, e = _graph(spark, list("ab"), [("a", "b"), ("a", "b"), ("b", "a")])
    assert {r["username"]: round(r["pagerank"], 9) for r in G.pagerank(nodes, e).collect()} == {"a": 0.5, "b": 0.5}
    none, no_edges = nodes.limit(0), e.limit(0)
    assert G.pagerank(none, no_edges).count() == 0 and G.betweenness(none, no_edges).count() == 0


def test_aligned_features_raise_on_other_labels(spark):
    fx = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 2.0)], "username string, churn int, x double")
    def net(label):
        return spark.createDataFrame([("a", 0, 0.1, 0.2, 0.3), ("b", label, 0.1, 0.2, 0.3)],
                                     "username string, churn int, degree_centrality double, betweenness_centrality double, pagerank double")
    assert G.aligned_features(fx, net(1)).count() == 2
    with pytest.raises(Exception, match="label mismatch"):
        G.aligned_features(fx, net(0)).collect()

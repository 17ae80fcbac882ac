"""Components against a plain union-find, on chains, stars and random links."""

import random

import pytest

from churnlens.llm.components import UnionFind, components


def plain(links):
    nodes = sorted({x for e in links for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    uf = UnionFind(len(nodes))
    for a, b in links:
        uf.union(at[a], at[b])
    return {x: nodes[uf.find(at[x])] for x in nodes if nodes[uf.find(at[x])] != x}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "loops"])
def test_against_union_find(spark, kind):
    rng = random.Random(4)
    links = {"chain": [(i, i + 1) for i in range(-20, 40)], "star": [(500, i) for i in range(200)],
             "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
             "loops": [(1, 1), (2, 2), (3, 1), (1, 3), (3, 1)]}[kind]
    df = spark.createDataFrame(links, "a long, b long").unionAll(spark.createDataFrame([(None, 7)], "a long, b long"))
    assert {r.node: r.component for r in components(df).collect()} == plain(links)


def test_empty(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

"""Connected components of a link table by alternating large and small stars.

Every round joins each link with the least neighbour of its ends, so the links of a
component contract to a star around its least node in a number of rounds that grows
with the logarithm of the component's size.  All steps are aggregates (combined
before they are shuffled) and equi-joins that AQE can split at a hot node; no list of
a node's neighbours is ever built, and nothing but one count and one checksum per
round reaches the driver.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import materialize


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo") % 1_000_003).alias("s")).first()
    return r["n"], r["s"]


def _smaller(links: DataFrame) -> DataFrame:
    """Large star: the higher end of each link is tied to the least neighbour of its lower end."""
    least = links.select(F.col("lo").alias("node"), F.col("lo").alias("near")) \
        .unionAll(links.select(F.col("hi").alias("node"), F.col("lo").alias("near"))) \
        .groupBy("node").agg(F.min("near").alias("least"))
    return links.join(least, links["lo"] == least["node"]).select("hi", F.col("least").alias("lo")).distinct()


def _star(links: DataFrame) -> DataFrame:
    """Small star: all lower neighbours of a node are tied to the least of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = links.join(least, "hi").where("lo != least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionAll(least.select("hi", F.col("least").alias("lo"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links`` that is not itself the least of its component.

    ``component`` is the least node reachable.  Loops, repeated links, either direction and nulls
    (ignored) are allowed; an empty table gives an empty result."""
    links = materialize(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    before = _state(links)
    while before[0]:
        links = materialize(_star(_smaller(links)), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


class UnionFind:
    """Union-find over 0..n-1 for the links found inside one task's block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True

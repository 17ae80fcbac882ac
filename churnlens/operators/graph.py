"""Follow graph and centralities (GRA1-GRA8, JOIN3-JOIN5).

Nodes and edges are DataFrames; every centrality is a sequence of joins and
aggregates keyed by node.  Iterative algorithms cut their lineage by
writing intermediate tables into the shared ``spark.checkpoint.dir`` folder.

Skew note: in the proxy graph every edge points at one of five hub users, so
in-degree is extremely skewed.  All per-destination sums are plain aggregates
(map-side partial aggregation before the shuffle), which keeps the hub's
partition to one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.latent import user_index
from churnlens.operators.sampling import hash_key
from churnlens.session import ensure_checkpoint_dir, materialize

HUB_COUNT = 5
SKIP_TOP = 1


def graph_nodes(raw: DataFrame) -> DataFrame:
    """One node per row of the raw-user table (unique by username) with label and (null → 0) counts."""
    return raw.select("username", "churn",
                       F.coalesce(F.col("followers"), F.lit(0)).cast("long").alias("followers"),
                       F.coalesce(F.col("following"), F.lit(0)).cast("long").alias("following"),
                      F.coalesce(F.col("public_repos"), F.lit(0)).cast("long").alias("repos"))


def top_followed(nodes: DataFrame, hubs: int = HUB_COUNT, skip_top: int = SKIP_TOP) -> DataFrame:
    """The ``skip_top + hubs`` most-followed users with their 0-based position.

    ``orderBy(...).limit`` is a distributed top-k (TakeOrderedAndProject); the
    position window then runs over those few rows only.
    """
    top = nodes.orderBy(F.desc("followers"), "username").limit(skip_top + hubs).select("username", "followers")
    w = Window.orderBy(F.desc("followers"), "username")
    return top.select(F.col("username").alias("dst"), (F.row_number().over(w) - 1).alias("pos"))


def follow_edges(nodes: DataFrame, hubs: int = HUB_COUNT, skip_top: int = SKIP_TOP) -> DataFrame:
    """Proxy edges: a user following f > 0 others points at positions
    ``skip_top .. skip_top + min(f, hubs) - 1`` of the most-followed list, never at itself.

    Each user expands to at most ``hubs`` position rows, which equi-join the
    hub list (its size is ``skip_top + hubs``, fixed, so the broadcast is bounded).
    """
    top = top_followed(nodes, hubs, skip_top)
    pos = (nodes.where(F.col("following") > 0)
           .select(F.col("username").alias("src"),
                   F.explode(F.sequence(F.lit(skip_top),
                                        F.least(F.col("following"), F.lit(hubs)).cast("int") + F.lit(skip_top - 1)))
                   .alias("pos")))
    # nodes and positions are unique, and so are their edges
    return pos.join(F.broadcast(top), "pos").where(F.col("src") != F.col("dst")).select("src", "dst")


def graph_density(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """m / (n (n − 1)) from one aggregate over the tagged union of nodes and edges."""
    tagged = nodes.select(F.lit(1).alias("_k")).unionByName(edges.select(F.lit(2).alias("_k")))
    nm = tagged.agg(F.count_if(F.col("_k") == 1).alias("n"), F.count_if(F.col("_k") == 2).alias("m"))
    return nm.select(
        "n", "m", F.when(F.col("n") > 1, F.col("m") / (F.col("n") * (F.col("n") - 1))).otherwise(F.lit(0.0)).alias("density"))


def degree_centrality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(in + out) / (n − 1) per node; isolated nodes get 0."""
    n = nodes.count()
    out_d = edges.groupBy(F.col("src").alias("username")).agg(F.count(F.lit(1)).alias("out_degree"))
    in_d = edges.groupBy(F.col("dst").alias("username")).agg(F.count(F.lit(1)).alias("in_degree"))
    scale = 1.0 / (n - 1) if n > 1 else 0.0
    return (nodes.select("username").join(out_d, "username", "left").join(in_d, "username", "left")
            .select("username",
                    F.coalesce("in_degree", F.lit(0)).alias("in_degree"),
                    F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
                    ((F.coalesce("in_degree", F.lit(0)) + F.coalesce("out_degree", F.lit(0))) * F.lit(scale))
                    .alias("degree_centrality")))


#: Targets of a source that one row of the adjacency table holds at most.
BLOCK_TARGETS = 4096


@dataclass
class Adjacency:
    """A graph over dense ids: ``ids`` (username, id), ``blocks`` (src, block, outdeg, targets), the targets of a
    source cut at a fixed length, and ``counts`` (src, outdeg, blocks) of every source.

    A hot source is many rows of one size under keys of their own, (src, block), so its edges lie in
    as many tasks as they need; 8-byte ids travel in place of names."""

    ids: DataFrame
    blocks: DataFrame
    counts: DataFrame
    n: int


def adjacency(nodes: DataFrame, edges: DataFrame, block: int = BLOCK_TARGETS) -> Adjacency:
    """The adjacency of the edges between ``nodes`` (unique by username); edges that repeat count as often."""
    ids = materialize(user_index(nodes.select("username"), name="id"), "graph-ids")
    src = ids.select(F.col("username").alias("src"), F.col("id").alias("_s"))
    dst = ids.select(F.col("username").alias("dst"), F.col("id").alias("_d"))
    # a name with many edges meets its id in a join whose hot partitions AQE splits
    e = materialize(edges.join(src, "src").join(dst, "dst").select(F.col("_s").alias("src"), F.col("_d").alias("dst")), "graph-id-edges")
    counts = materialize(e.groupBy("src").agg(F.count(F.lit(1)).alias("outdeg"))
                         .withColumn("blocks", F.ceil(F.col("outdeg") / F.lit(block)).cast("int")), "graph-degrees")
    # a target's block is its hash's: a block holds about ``block`` targets, and no source is in one task
    blocks = (e.join(counts, "src").withColumn("block", F.pmod(F.xxhash64("dst"), F.col("blocks")).cast("int"))
              .groupBy("src", "block").agg(F.first("outdeg").alias("outdeg"), F.collect_list("dst").alias("targets")))
    return Adjacency(ids, materialize(blocks, "graph-blocks"), counts, ids.count())


def _per_block(rows: DataFrame, node: str, counts: DataFrame) -> DataFrame:
    """``rows`` once per block of their node's targets; rows whose node has none are left out."""
    few = counts.select(F.col("src").alias(node), "blocks")
    return rows.join(few, node).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")


def pagerank(nodes: DataFrame, edges: DataFrame, alpha: float = 0.85, max_iter: int = 100,
             tol: float | None = 1.0e-6, checkpoint_every: int = 5,
             fair_share: int | None = None, graph: Adjacency | None = None) -> DataFrame:
    """Power iteration with uniform teleport; dangling mass is spread uniformly.

    Stops when the L1 change is below ``n · tol`` and raises if ``max_iter`` rounds do not
    get there; ``tol=None`` runs exactly ``max_iter`` rounds and then reads only the
    dangling mass of each round.  Targets lie in blocks of at most about ``fair_share`` under (source,
    block), partitioned once and kept; a rank is repeated once per block of its source.
    What a round shuffles is ranks to blocks and sums to targets, both under 8-byte ids.
    Each round's rank table is the static node table joined with that round's
    contributions (it refers to the previous table once, so the plan grows linearly).
    Lineage is cut by writing the rank table every ``checkpoint_every`` rounds.
    """
    spark = nodes.sparkSession
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = graph or adjacency(nodes, edges, fair_share or BLOCK_TARGETS)
    n = g.n
    if n == 0:
        return nodes.select("username", F.lit(0.0).alias("pagerank"))
    e = g.blocks.withColumnRenamed("src", "id").repartition(parts, "id", "block").persist(StorageLevel.MEMORY_AND_DISK)
    ids = (g.ids.select("id").join(g.counts.select(F.col("src").alias("id"), "blocks"), "id", "left")
           .repartition(parts, "id").persist(StorageLevel.MEMORY_AND_DISK))
    dsum = ids.agg(F.count_if(F.col("blocks").isNull()).alias("nd")).first()["nd"] / n
    x = ids.withColumn("rank", F.lit(1.0 / n))
    converged, held = tol is None, []
    for it in range(1, max_iter + 1):
        # ranks meet their targets on (source, block); a node without edges sends none
        sent = x.where(F.col("blocks").isNotNull()).select(
            "id", "rank", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        contrib = (e.join(sent, ["id", "block"])
                   .select(F.explode("targets").alias("id"), (F.col("rank") / F.col("outdeg")).alias("c"))
                   .groupBy("id").agg(F.sum("c").alias("c")))
        base = alpha * dsum / n + (1.0 - alpha) / n
        new = (ids.join(contrib, "id", "left")
               .select("id", "blocks", (F.lit(alpha) * F.coalesce(F.col("c"), F.lit(0.0)) + F.lit(base)).alias("rank")))
        if it % checkpoint_every == 0 or it == max_iter:
            new = materialize(new, "pagerank")
        else:
            new = new.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(new)
        dangling = F.coalesce(F.sum(F.when(F.col("blocks").isNull(), F.col("rank"))), F.lit(0.0)).alias("d")
        if tol is None:
            row = new.agg(dangling).first()
        else:  # the join with the previous ranks serves the L1 change only and never feeds later rounds
            row = (new.join(x.select("id", F.col("rank").alias("old")), "id")
                   .agg(F.sum(F.abs(F.col("rank") - F.col("old"))).alias("err"), dangling).first())
        x, dsum = new, row["d"]
        while len(held) > 1:
            held.pop(0).unpersist()
        if tol is not None and row["err"] < n * tol:
            converged = True
            break
    if not converged:
        raise RuntimeError(f"PageRank did not converge to {tol} in {max_iter} rounds")
    out = materialize(x.join(g.ids, "id").select("username", F.col("rank").alias("pagerank")), "pagerank")
    for y in (*held, e, ids):
        y.unpersist()
    return out


def sample_sources(nodes: DataFrame, k: int = 50, seed: int = 42) -> DataFrame:
    """The k nodes with the smallest md5(seed:username) (all nodes when n ≤ k)."""
    return nodes.select("username", hash_key("username", seed).alias("_h")).orderBy("_h", "username").limit(k) \
        .select(F.col("username").alias("source"))


#: Sources that are followed at once: one bit each of a node's mark.
SOURCES_AT_ONCE = 62


def betweenness(nodes: DataFrame, edges: DataFrame, k: int = 50, seed: int = 42,
                normalized: bool = True, graph: Adjacency | None = None) -> DataFrame:
    """Directed shortest-path betweenness from sampled sources (Brandes).

    Forward: level-synchronous BFS over (source, node, sigma) — the frontier meets the adjacency
    on (node, block), so a hub's targets are dealt to many tasks, and one aggregate per
    level sums the paths.  Which sources have reached a node is one bit each of the node's mark, so a
    level is checked against one (node, mark) row per node and not against all earlier levels.  Backward:
    deltas flow from a level to the one before it through the same join.  ``k`` sources are always given, all
    nodes only where there are no more.  State grows with sources × reachable nodes, not with n².
    Scaling: 1 / ((n−1)(n−2)), times n/k when sampling.
    """
    spark = nodes.sparkSession
    ensure_checkpoint_dir(spark)
    g = graph or adjacency(nodes, edges)
    n = g.n
    k_used = k if k < n else None
    chosen = [r["id"] for r in sample_sources(nodes, k, seed).join(g.ids, F.col("source") == F.col("username"))
              .select("id").orderBy("id").collect()]  # k rows
    total = None
    for first in range(0, len(chosen), SOURCES_AT_ONCE):
        part = _deltas(spark, g, chosen[first:first + SOURCES_AT_ONCE])
        if part is not None:
            total = part if total is None else total.unionByName(part)
    scale = 1.0
    if normalized:
        scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
        if k_used is not None:
            scale = scale * n / k_used
    if total is None:
        return nodes.select("username", F.lit(0.0).alias("betweenness_centrality"))
    agg = total.groupBy(F.col("node").alias("id")).agg(F.sum("delta").alias("b"))
    return g.ids.join(agg, "id", "left").select(
        "username", (F.coalesce("b", F.lit(0.0)) * F.lit(scale)).alias("betweenness_centrality"))


def _steps(rows: DataFrame, g: Adjacency) -> DataFrame:
    """Rows (source, node, sigma) with each target of the node as ``dst``."""
    blocks = g.blocks.select(F.col("src").alias("node"), "block", "targets")
    return _per_block(rows, "node", g.counts).join(blocks, ["node", "block"]) \
        .select("source", "node", "sigma", F.explode("targets").alias("dst"))


def _deltas(spark, g: Adjacency, sources: list[int]) -> DataFrame | None:
    """(node, delta) of one group of sources; a source is known by its place in the list."""
    frontier = spark.createDataFrame([(i, s, 1.0) for i, s in enumerate(sources)], "source int, node long, sigma double")
    frontier = materialize(frontier, "brandes-level")
    levels, marks = [frontier], None
    bit = F.expr("shiftleft(1L, source)")
    while True:
        fresh = frontier.groupBy("node").agg(F.bit_or(bit).alias("mark"))
        if marks is not None:
            fresh = marks.unionByName(fresh).groupBy("node").agg(F.bit_or("mark").alias("mark"))
        marks = materialize(fresh, "brandes-marks")
        found = _steps(frontier, g).groupBy("source", F.col("dst").alias("node")).agg(F.sum("sigma").alias("sigma"))
        new = F.coalesce(F.col("mark"), F.lit(0)).bitwiseAND(bit) == 0
        nxt = materialize(found.join(marks, "node", "left").where(new).select("source", "node", "sigma"), "brandes-level")
        if nxt.isEmpty():
            break
        levels.append(nxt)
        frontier = nxt
    # backward sweep: delta(v) = Σ_{v→w, dist(w)=dist(v)+1} sigma_v / sigma_w · (1 + delta_w)
    own = F.element_at(F.array(*[F.lit(s) for s in sources]), F.col("source") + 1)
    deeper, total = levels[-1].withColumn("delta", F.lit(0.0)), None
    for here in reversed(levels[:-1]):
        contrib = (_steps(here, g)
                   .join(deeper.select("source", F.col("node").alias("dst"), F.col("sigma").alias("sw"),
                                       F.col("delta").alias("dw")), ["source", "dst"])
                   .groupBy("source", "node")
                   .agg(F.sum(F.col("sigma") / F.col("sw") * (F.lit(1.0) + F.col("dw"))).alias("delta")))
        deeper = materialize(here.join(contrib, ["source", "node"], "left")
                             .select("source", "node", "sigma", F.coalesce("delta", F.lit(0.0)).alias("delta")), "brandes-delta")
        part = deeper.where(F.col("node") != own).select("node", "delta")
        total = part if total is None else total.unionByName(part)
    return total


def network_features(users: DataFrame, degree: DataFrame, between: DataFrame, pr: DataFrame) -> DataFrame:
    """Attach the three centralities to users; a missing node gets 0 (JOIN3)."""
    return (users.join(degree.select("username", "degree_centrality"), "username", "left")
            .join(between, "username", "left").join(pr, "username", "left")
            .fillna(0.0, subset=["degree_centrality", "betweenness_centrality", "pagerank"]))


def subgraph(nodes: DataFrame, edges: DataFrame, keep: DataFrame):
    """The subgraph that the nodes of ``keep`` (username) induce: those nodes and the edges among them."""
    names = keep.select("username").distinct()
    sub_e = (edges.join(names.withColumnRenamed("username", "src"), "src", "left_semi")
             .join(names.withColumnRenamed("username", "dst"), "dst", "left_semi").select("src", "dst"))
    return nodes.join(names, "username", "left_semi"), sub_e


def aligned_features(features: DataFrame, network: DataFrame, label: str = "churn") -> DataFrame:
    """Inner join of the feature table and the network table on the key; a row whose labels differ raises."""
    j = features.join(network.select("username", F.col(label).alias("_label2"), "degree_centrality",
                                     "betweenness_centrality", "pagerank"), "username")
    told = F.lit("label mismatch between the feature table and the network table")
    # checked in the row itself, so the join runs once
    checked = F.when(F.col(label) != F.col("_label2"), F.raise_error(told).cast(j.schema[label].dataType)).otherwise(F.col(label))
    return j.withColumn(label, checked).drop("_label2")

"""Nearest neighbours by inner product: vantage-point trees per shard, searched by query blocks.

Inner products are turned into distances: with R the longest norm of a shard, a vector x gets the further
component sqrt(R^2 - |x|^2) and a query the component 0, so that |q - x|^2 = |q|^2 + R^2 - 2 q.x falls as the
product rises.  In that space every shard has a vantage-point tree: a node orders its vectors by their
distance to a vantage point and halves them; each half is known by the interval of its distances.  By the
triangle inequality a query at distance d from the vantage point is at least lo - d and d - hi away from a
half with the interval [lo, hi].  A half is searched if ``factor`` times that bound (the largest on the way down)
is not beyond the query's k-th distance so far.  Factor one is exact; a larger one prunes more and may miss.

Equal vectors are one class that keeps its k + 1 least ids, which is all that a result can show of them, so
copies of any number cost nothing.  Classes are dealt to shards by hash: every vector is indexed, and no
shard grows with the data.  Queries visit every shard in blocks, a task holds one shard and one block, and a
query's result is the best of its shards'.  A tree prunes; the scores that rank are products in double
precision, added component by component in order, so that equal vectors tie wherever they lie.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from churnlens.llm.embedding_join import usable
from churnlens.session import materialize

K = 20
#: Vectors in a shard, queries in a block, vectors in a leaf.
SHARD, BLOCK, LEAF = 8192, 2048, 64
#: How far the triangle inequality's bound is stretched (one: exact search).
FACTOR = 1.0
_SAMPLE = 256


# ---- one shard ----------------------------------------------------------------------------------------

class Tree:
    """Vantage-point tree over the rows of ``x``; position in ``x`` breaks ties of the product."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, arrays: dict | None = None):
        self.x = x
        with np.errstate(all="ignore"):
            norms = (x * x).sum(1)
            self.r2 = float(norms.max()) if len(x) else 0.0
            self.extra = np.sqrt(np.maximum(self.r2 - norms, 0.0))
        if arrays is not None:
            self.order, self.nodes, self.bounds = arrays["order"], arrays["nodes"], arrays["bounds"]
            return
        self.order = np.arange(len(x), dtype=np.int32)
        nodes, bounds, todo = [], [], deque([(0, len(x))] if len(x) else [])
        while todo:  # level by level, so a half's number follows from how many nodes wait before it
            s, e = todo.popleft()
            if e - s <= leaf or not np.isfinite(self.r2):
                nodes.append((s, e, -1, -1, -1))
                bounds.append((0.0, 0.0, 0.0, 0.0))
                continue
            v = self._vantage(self.order[s:e])
            d = self._between(v, self.order[s:e])
            by = np.argsort(d, kind="stable")
            self.order[s:e], d = self.order[s:e][by], d[by]
            mid, first = (e - s) // 2, len(nodes) + 1 + len(todo)
            nodes.append((s, e, v, first, first + 1))
            bounds.append((d[0], d[mid - 1], d[mid], d[-1]))
            todo.extend([(s, s + mid), (s + mid, e)])
        self.nodes = np.array(nodes, np.int32).reshape(-1, 5)
        self.bounds = np.array(bounds, np.float64).reshape(-1, 4)

    def _between(self, v: int, at: np.ndarray) -> np.ndarray:
        diff = self.x[at] - self.x[v]
        return np.sqrt((diff * diff).sum(1) + (self.extra[at] - self.extra[v]) ** 2)

    def _vantage(self, at: np.ndarray) -> int:
        """Of a few rows, the one whose distances to a sample vary most."""
        few = at[np.linspace(0, len(at) - 1, min(len(at), 8)).astype(int)]
        sample = at[np.linspace(0, len(at) - 1, min(len(at), _SAMPLE)).astype(int)]
        return int(max(few, key=lambda v: (float(self._between(v, sample).std()), -int(v))))

    def search(self, q: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, int]:
        """Products and rows (-1: none) of each query's ``k`` best, best first, and how many products were made."""
        found = Best(len(q), k)
        if not len(self.x) or not len(q):
            return found.score, found.row, 0
        with np.errstate(all="ignore"):
            scale = (q * q).sum(1) + self.r2
            slack = 1e-7 * np.sqrt(scale)
            home, made = np.zeros(len(q), np.int32), 0

            def far(node: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Bounds of the queries on the two halves of a node."""
                v = self.nodes[node, 2]
                d = np.sqrt(np.maximum(scale[who] - 2 * (q[who] @ self.x[v]), 0.0))
                a, b, c, e = self.bounds[node]
                return np.maximum(a - d, d - b), np.maximum(c - d, d - e)

            def leaf(node: int, who: np.ndarray) -> None:
                nonlocal made
                s, e = self.nodes[node, :2]
                at = np.sort(self.order[s:e])
                made += len(who) * len(at)
                rough = q[who] @ self.x[at].T
                # rounding of the rough product must not lose a row: it is left some room
                near = ~(rough < (found.score[who, -1] - 1e-12 * scale[who])[:, None])
                found.add(who, at, near, q, self.x)

            # first down to the leaf on each query's side, so that there is something to prune by
            todo = [(0, np.arange(len(q)))]
            while todo:
                node, who = todo.pop()
                if self.nodes[node, 2] < 0:
                    home[who] = node
                    leaf(node, who)
                    continue
                inner, outer = far(node, who)
                side = inner <= outer
                todo += [(int(c), who[m]) for c, m in ((self.nodes[node, 3], side), (self.nodes[node, 4], ~side)) if m.any()]
            # then every node once, with the queries that it may still help
            todo = [(0, np.arange(len(q)), np.zeros(len(q)))]
            while todo:
                node, who, bound = todo.pop()
                limit = np.sqrt(np.maximum(scale[who] - 2 * found.score[who, -1], 0.0)) + slack[who]
                open_ = ~(bound * factor > limit)
                if self.nodes[node, 2] < 0:
                    open_ &= home[who] != node
                who, bound = who[open_], bound[open_]
                if not len(who):
                    continue
                if self.nodes[node, 2] < 0:
                    leaf(node, who)
                    continue
                inner, outer = far(node, who)
                todo += [(int(self.nodes[node, 4]), who, np.maximum(bound, outer)),
                         (int(self.nodes[node, 3]), who, np.maximum(bound, inner))]
        return found.score, found.row, made


class Best:
    """The k best rows of each query so far: highest product, then smallest row."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), -np.inf)
        self.row = np.full((n, k), -1, np.int64)

    def add(self, who: np.ndarray, at: np.ndarray, near: np.ndarray, q: np.ndarray, x: np.ndarray) -> None:
        some = near.any(1)
        who, near = who[some], near[some]
        for s in range(0, len(who), 512):
            w, m = who[s:s + 512], near[s:s + 512]
            i, j = np.nonzero(m)
            score = np.full(m.shape, -np.inf)
            score[i, j] = products(q[w[i]], x[at[j]])
            row = np.where(m, at, -1)
            score = np.concatenate((self.score[w], score), 1)
            row = np.concatenate((self.row[w], row), 1)
            key = np.where(row < 0, np.iinfo(np.int64).max, row)
            first = np.lexsort((key, -score), axis=-1)[:, :self.score.shape[1]]
            self.score[w] = np.take_along_axis(score, first, 1)
            self.row[w] = np.take_along_axis(row, first, 1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, components added in order."""
    return np.add.accumulate(a * b, axis=1)[:, -1] + 0.0


# ---- tables -------------------------------------------------------------------------------------------

def _keyed(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Id, digest, vector (bytes of doubles) and length of the rows that take part."""
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs = [], []
            for i, v in zip(range(batch.num_rows), batch.column("_vec")):
                v = usable(v.values if v.is_valid else None)
                if v is not None:
                    ids.append(i)
                    vecs.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(ids, pa.int64())),
                 pa.array([hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in vecs], pa.binary()),
                 pa.array([v.tobytes() for v in vecs], pa.binary()), pa.array([len(v) for v in vecs], pa.int32())],
                names=["_id", "_key", "_vec", "_dim"])

    named = rows.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec")).where("_id is not null")
    return named.mapInArrow(run, f"_id {id_type}, _key binary, _vec binary, _dim int")


def _dealt(rows: DataFrame, sizes: DataFrame, most: int, name: str) -> DataFrame:
    """``rows`` with a number in ``name``, so that about ``most`` rows of a length share one, and how many there are."""
    parts = sizes.select("_dim", F.ceil(F.col("_n") / most).cast("int").alias(f"{name}s"))
    return rows.join(parts, "_dim").withColumn(name, F.pmod(F.xxhash64("_key"), F.col(f"{name}s")).cast("int"))


def _counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_dim").agg(F.count(F.lit(1)).alias("_n"))


def build_index(rows: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
                shard: int = SHARD, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """(rows that take part with their class, one row per shard with its vectors, ids and tree)."""
    keyed = _keyed(rows, id_col, vec_col)
    ids = keyed.select("_key", "_id").distinct()
    order = Window.partitionBy("_key").orderBy("_id")  # trimmed to k + 1 before the shuffle
    ids = ids.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1) \
        .groupBy("_key").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    vecs = keyed.groupBy("_key").agg(F.first("_vec").alias("_vec"), F.first("_dim").alias("_dim"))
    classes = materialize(vecs.join(ids, "_key"), "vp-classes")
    id_list = classes.schema["_ids"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        first = pa.array([x[0] for x in table.column("_ids").to_pylist()])
        table = table.take(pc.sort_indices(first))  # a row's place stands for its least id
        x = np.frombuffer(b"".join(table.column("_vec").to_pylist()), np.float64).reshape(table.num_rows, -1)
        t = Tree(x, leaf)
        return pa.table({
            "_dim": table.column("_dim").slice(0, 1), "_shard": table.column("_shard").slice(0, 1),
            "_keys": pa.array([table.column("_key").to_pylist()], pa.list_(pa.binary())),
            "_vecs": pa.array([x.tobytes()], pa.binary()), "_order": pa.array([t.order.tobytes()], pa.binary()),
            "_nodes": pa.array([t.nodes.tobytes()], pa.binary()), "_bounds": pa.array([t.bounds.tobytes()], pa.binary()),
            "_lists": pa.array([table.column("_ids").to_pylist()], pa.list_(table.schema.field("_ids").type))})

    index = _dealt(classes, _counts(classes), shard, "_shard").select("_dim", "_shard", "_key", "_vec", "_ids") \
        .groupBy("_dim", "_shard").applyInArrow(
            run, "_dim int, _shard int, _keys array<binary>, _vecs binary, _order binary, _nodes binary, _bounds binary, "
                 f"_lists array<{id_list}>")
    return keyed, materialize(index, "vp-index")


def search_index(queries: DataFrame, index: DataFrame, k: int, factor: float = FACTOR, block: int = BLOCK) -> DataFrame:
    """(_key, _near) of every query class: its ``k`` best (score, id, class of that id) in order.
    ``queries``: _key, _vec, _dim, one row per class."""
    ids_type = index.schema["_lists"].dataType.elementType
    sizes = _counts(queries)
    shards = index.groupBy("_dim").agg(F.max(F.col("_shard") + 1).alias("_shards"))
    seats = _dealt(queries, sizes, block, "_block").join(shards, "_dim") \
        .withColumn("_shard", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1))) \
        .select("_dim", "_shard", "_block", "_key", "_vec")
    blocks = sizes.select("_dim", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / block).cast("int") - 1)).alias("_block"))
    held = index.join(blocks, "_dim")
    out = pa.schema([("_key", pa.binary()), ("_score", pa.float64()), ("_class", pa.binary()), ("_ids", to_arrow_type(ids_type))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:  # hashing may leave a shard or a block empty
            return out.empty_table()
        r = right.select(["_dim", "_keys", "_vecs", "_order", "_nodes", "_bounds"]).to_pylist()[0]
        tree = Tree(np.frombuffer(r["_vecs"], np.float64).reshape(-1, r["_dim"]), arrays={
            "order": np.frombuffer(r["_order"], np.int32), "nodes": np.frombuffer(r["_nodes"], np.int32).reshape(-1, 5),
            "bounds": np.frombuffer(r["_bounds"], np.float64).reshape(-1, 4)})
        q = np.frombuffer(b"".join(left.column("_vec").to_pylist()), np.float64).reshape(left.num_rows, -1)
        score, row, _ = tree.search(q, k, factor)
        i, j = np.nonzero(row >= 0)
        at = pa.array(row[i, j])
        return pa.table({"_key": left.column("_key").take(pa.array(i)), "_score": pa.array(score[i, j]),
                         "_class": pa.array(r["_keys"], pa.binary()).take(at),
                         "_ids": right.column("_lists").combine_chunks().flatten().take(at).cast(out.field("_ids").type)})

    keys = ["_dim", "_shard", "_block"]
    got = seats.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
        run, f"_key binary, _score double, _class binary, _ids {ids_type.simpleString()}")
    best = Window.partitionBy("_key").orderBy(F.col("_score").desc(), F.col("_ids")[0])
    named = got.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k) \
        .select("_key", "_score", "_class", F.explode("_ids").alias("_id"))
    best = Window.partitionBy("_key").orderBy(F.col("_score").desc(), "_id")
    return named.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).groupBy("_key") \
        .agg(F.sort_array(F.collect_list(F.struct("_r", "_score", "_id", "_class"))).alias("_near"))


def nearest(rows: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", where: Column | None = None,
            k: int = K, factor: float = FACTOR, shard: int = SHARD, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the neighbour's id and ``score`` (inner product) of the ``k`` nearest
    other rows of every row that ``where`` (a condition on the id column; default: all) names.

    Vectors that are null, empty, zero or hold a null or non-finite component, and rows without an id,
    take no part.  Vectors of different lengths are never compared.  Products that tie go to the smaller id.
    Rows that repeat id and vector count once; an id with several vectors is a candidate and a query by each,
    and only a query's own pair of id and vector is left out.  A product beyond the range of doubles is
    infinite and ranks so.  Other columns are not read."""
    keyed, index = build_index(rows, id_col=id_col, vec_col=vec_col, k=k, shard=shard, leaf=leaf)
    asked = keyed.withColumnRenamed("_id", id_col)
    asked = (asked if where is None else asked.where(where)).withColumnRenamed(id_col, "_query")
    asked = materialize(asked, "vp-queries")
    classes = asked.groupBy("_key").agg(F.first("_vec").alias("_vec"), F.first("_dim").alias("_dim"))
    near = search_index(classes, index, k + 1, factor, block)
    others = F.filter("_near", lambda x: (x["_id"] != F.col("_query")) | (x["_class"] != F.col("_key")))
    return asked.select("_query", "_key").distinct().join(near, "_key") \
        .select("_query", F.posexplode(F.slice(others, 1, k)).alias("_p", "_n")) \
        .select(F.col("_query").alias("query_id"), (F.col("_p") + 1).alias("rank"),
                F.col("_n._id").alias(id_col), F.col("_n._score").alias("score"))

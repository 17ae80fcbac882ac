"""Near-duplicate vectors by an exact metric range join.

On unit vectors a cosine of at least c is a Euclidean distance of at most
r = sqrt(2 - 2c).  Pivots (the classes with the smallest digests) partition the
vectors: each belongs to the cell of its nearest pivot.  Two vectors within r of each
other in the cells of pivots p and q both lie within r of the bisector of p and q (the
triangle inequality on the distance to it), so a vector is copied, as a guest, to those
cells with a smaller number whose bisector is that near, and every pair meets in
exactly one cell.  Cells join independently: owners with owners and owners with guests.

Equal vectors are one class with a weight, so copies are never paired.  A cell whose
owners or guests exceed ``block`` is cut into blocks that are joined block by block in
different tasks; a task holds two blocks at most.  Inside a task the links are counted
per vector and reduced to a spanning forest, so no pairs are written.
"""

from __future__ import annotations

import hashlib
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.components import components
from churnlens.session import materialize

THRESHOLD = 0.95
BLOCK = 6144
#: Pivots are broadcast, so their number has a bound; cells beyond it grow and are cut into blocks.
MOST_PIVOTS = 1024


def usable(values) -> np.ndarray | None:
    """The vector in double precision, or None if it is null, zero, empty or not finite throughout."""
    if values is None or values.null_count or not len(values):
        return None
    v = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 becomes 0.0
    if not np.isfinite(v).all() or not v.any():
        return None
    return v


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _vectors(column) -> np.ndarray:
    """Rows of unit vectors from a column of equally long binaries of doubles."""
    raw = b"".join(x.as_py() for x in column)
    return _unit(np.frombuffer(raw, np.float64).reshape(len(column), -1)) if len(column) else np.zeros((0, 1))


def classes_of(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the class key of each, classes with weight, least id and vector); unusable ones have no key."""
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keys, vecs, dims = [], [], []
            for x in batch.column("_vec"):
                v = usable(x.values if x.is_valid else None)
                keys.append(None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).hexdigest())
                vecs.append(None if v is None else v.tobytes())
                dims.append(None if v is None else len(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(keys, pa.string()), pa.array(vecs, pa.binary()), pa.array(dims, pa.int32())],
                names=["_id", "_key", "_vec", "_dim"])

    keyed = rows.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec")) \
        .mapInArrow(run, f"_id {id_type}, _key string, _vec binary, _dim int")
    groups = keyed.where("_key is not null").groupBy("_key").agg(
        F.count(F.lit(1)).alias("_w"), F.min("_id").alias("_first"), F.first("_vec").alias("_vec"), F.first("_dim").alias("_dim"))
    return keyed.select("_id", "_key"), materialize(groups, "vector-classes")


def place(classes: DataFrame, pivots: np.ndarray, radius: float) -> DataFrame:
    """Each class with its own cell and the cells it visits as a guest."""
    spread = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 1e-18))

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                near = _vectors(part.column("_vec")) @ pivots.T
                own = near.argmax(1)
                # distance to the bisector: (|x-q|^2 - |x-p|^2) / (2 |p-q|) with |x-p|^2 = 2 - 2 x.p
                apart = (near[np.arange(len(own)), own][:, None] - near) / spread[own]
                visit = (apart <= radius + 1e-9) & (np.arange(len(pivots)) < own[:, None])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("_w"), part.column("_vec"), pa.array(own.astype(np.int32)),
                     pa.array([np.flatnonzero(v).astype(np.int32) for v in visit], pa.list_(pa.int32()))],
                    names=["_key", "_w", "_vec", "_own", "_visits"])

    return classes.select("_key", "_w", "_vec").mapInArrow(
        run, "_key string, _w bigint, _vec binary, _own int, _visits array<int>")


def join_block(own: np.ndarray, guests: np.ndarray, weights: np.ndarray, threshold: float,
               among: bool) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Linked weight of every vector (owners first, then guests) and a spanning forest of the links of
    owners with guests and, if ``among``, of owners with each other."""
    n, both = len(own), np.concatenate((own, guests)) if among else guests
    first = 0 if among else n
    count = np.zeros(n + len(guests), np.int64)
    label, forest = np.arange(n + len(guests)), []
    for s in range(0, n, 512):
        hit = own[s:s + 512] @ both.T >= threshold
        if among:  # each pair once: an owner with the owners after it
            hit[:, :n] &= np.arange(n) > np.arange(s, min(s + 512, n))[:, None]
        for i in np.flatnonzero(hit.any(1)):
            at = np.flatnonzero(hit[i]) + first
            count[s + i] += weights[at].sum()
            count[at] += weights[s + i]
            other, where = np.unique(label[at], return_index=True)
            mine = label[s + i]
            fresh = other != mine
            if fresh.any():
                forest.extend((s + int(i), int(at[w])) for w in where[fresh])
                label[np.isin(label, other[fresh])] = mine
    return count, forest


def link(classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK,
         most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """(a, b, n) over classes of one dimension: rows with null b give the weight n linked to class a (in
    parts), the others are links whose components are those of all links."""
    n = classes.count()
    schema = "a string, b string, n bigint"
    if n == 0:
        return classes.sparkSession.createDataFrame([], schema)
    pivots = classes.select("_vec").orderBy("_key").limit(min(max(1, ceil(n / block)), most_pivots)).collect()
    pivots = _unit(np.stack([np.frombuffer(r["_vec"], np.float64) for r in pivots]))
    placed = materialize(place(classes, pivots, sqrt(max(0.0, 2 - 2 * threshold))), "vector-cells")

    # one row per cell: how many blocks its owners and its guests are cut into
    def sizes(cells):
        return {r["c"]: r["n"] for r in cells.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}

    owners = sizes(placed.select(F.col("_own").alias("c")))
    guests = sizes(placed.select(F.explode("_visits").alias("c")))
    blocks = F.array(*[F.lit(max(1, ceil(owners.get(c, 0) / block))) for c in range(len(pivots))])
    parts = F.array(*[F.lit(max(1, ceil(guests.get(c, 0) / block))) for c in range(len(pivots))])
    number = F.pmod(F.xxhash64("_key"), F.lit(1 << 40)).cast("bigint")
    # an owner block o meets guest parts 0..; owners of later blocks of the same cell come as parts of their own
    rows = placed.withColumn("_o", (number % F.get(blocks, "_own")).cast("int"))
    base = ["_key", "_w", "_vec"]
    seat = lambda cell, o, part, guest: F.struct(
        cell.cast("int").alias("cell"), o.cast("int").alias("o"), part.cast("int").alias("part"), guest.alias("guest"))
    outer = F.transform("_visits", lambda c: F.transform(
        F.sequence(F.lit(0), F.get(blocks, c) - 1),
        lambda o: seat(c, o, number % F.get(parts, c), F.lit(True))))
    inner_guest = F.when(F.col("_o") > 0, F.transform(
        F.sequence(F.lit(0), F.col("_o") - 1), lambda o: seat(F.col("_own"), o, -F.col("_o"), F.lit(True)))) \
        .otherwise(F.array().cast("array<struct<cell:int,o:int,part:int,guest:boolean>>"))
    as_owner = F.transform(
        F.sequence(F.col("_o") + 1 - F.get(blocks, "_own"), F.get(parts, "_own") - 1),
        lambda p: seat(F.col("_own"), F.col("_o"), F.when(p < 0, p - F.col("_o")).otherwise(p), F.lit(False)))
    seats = rows.select(*base, F.explode(F.concat(F.flatten(outer), inner_guest, as_owner)).alias("s")) \
        .select(*base, "s.*")

    def run(table: pa.Table) -> pa.Table:
        guest = table.column("guest").to_numpy()
        order = np.argsort(guest, kind="stable")
        table = table.take(pa.array(order))
        m = int((~guest).sum())
        keys, part = table.column("_key").to_pylist(), table.column("part")[0].as_py()
        v, w = _vectors(table.column("_vec")), table.column("_w").to_numpy()
        # part 0 also joins the owners with each other
        count, forest = join_block(v[:m], v[m:], w, threshold, among=part == 0)
        got = np.flatnonzero(count)
        return pa.table({"a": pa.array([keys[i] for i in got] + [keys[i] for i, _ in forest], pa.string()),
                         "b": pa.array([None] * len(got) + [keys[j] for _, j in forest], pa.string()),
                         "n": pa.array(count[got].tolist() + [0] * len(forest), pa.int64())})

    return seats.groupBy("cell", "o", "part").applyInArrow(run, schema)


def embedding_dedup(rows: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, block: int = BLOCK, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """One row per input row: id, ``n_links`` (other rows with a cosine of at least ``threshold``),
    ``component_id`` (least id reachable by links, itself included) and ``kept`` (id is component_id).

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, and
    vectors of different lengths do not link.  Repeated rows are different rows; a null id never names a
    component and is not kept.  Other columns are not read."""
    keyed, classes = classes_of(rows, id_col, vec_col)
    dims = [r["_dim"] for r in classes.select("_dim").distinct().collect()]  # as many as lengths of vectors
    found = None
    for d in sorted(dims):
        one = link(classes.where(F.col("_dim") == d), threshold, block, most_pivots)
        found = one if found is None else found.unionAll(one)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "a string, b string, n bigint")
    found = materialize(found, "vector-links")
    linked = found.where("b is null").groupBy("a").agg(F.sum("n").alias("_n"))
    rooted = classes.select("_key", "_w", "_first") \
        .join(components(found.where("b is not null")), F.col("_key") == F.col("node"), "left") \
        .select("_key", "_w", "_first", F.coalesce("component", "_key").alias("_root"))
    names = rooted.groupBy("_root").agg(F.min("_first").alias("_component"))
    told = rooted.join(names, "_root").join(linked, F.col("_key") == F.col("a"), "left") \
        .select("_key", (F.coalesce("_n", F.lit(0)) + F.col("_w") - 1).alias("_links"), "_component")
    usable_rows = keyed.where("_key is not null").join(told, "_key") \
        .select("_id", F.col("_links").alias("n_links"), F.col("_component").alias("component_id"))
    others = keyed.where("_key is null") \
        .select("_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id"))
    return usable_rows.unionAll(others).select(
        F.col("_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))

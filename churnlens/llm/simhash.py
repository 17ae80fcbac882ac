"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has a bit set where more than half of its word shingles' hashes
have it.  Texts with equal fingerprints are one class.  Classes that differ in at most
``max_bits`` bits are found like this:

* bits that go together are grouped into the same partition (co-occurrence counts of
  all fingerprints), which leaves the partitions as independent as possible;
* thresholds t_i with sum(t_i + 1) = max_bits + 1 are allocated to the partitions by
  dynamic programming over estimated candidate counts and probe counts, so a selective
  partition may get a larger threshold than a skewed one, and a partition may be left out
  (t = -1): two fingerprints within max_bits bits are within t_i bits in some partition i;
* each fingerprint is dealt to its value in every partition and to all values within
  t_i bits of it; fingerprints that meet are verified on all 64 bits.

A bucket that more than ``bucket`` fingerprints share is dealt again by the bits not
fixed yet, cut in max_bits + 1 parts of which one must be equal, until buckets are
small; a bucket with r free bits has at most 2^r members, so this ends (only members of
large buckets are copied, max_bits + 1 times each).  Inside a
bucket only a spanning forest of the verified links is kept, and the components of
all forests are joined by stars.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import byte_view
from churnlens.llm.components import UnionFind, components
from churnlens.session import materialize

SEED = 42
BITS = 64
BUCKET = 2048
SHINGLE_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the text's lower-cased word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    counts, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, SHINGLE_BLOCK):
        m = min(SHINGLE_BLOCK, n - k)
        pairs = zip(starts[k:k + m].tolist(), ends[k + shingle - 1:k + shingle - 1 + m].tolist())
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, m)
        counts += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``_id`` and ``_fp`` (the fingerprint's 64 bits as a signed long) of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            raw = data.tobytes()
            fps = np.fromiter((fingerprint(raw[a:b], shingle) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())),
                              np.uint64, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(fps.view(np.int64))], names=["_id", "_fp"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .mapInArrow(run, f"_id {id_type}, _fp bigint")


# ---------------------------------------------------------------- partitions and thresholds

def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many of them have both bits i and j, over all of them."""

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            total += x.T @ x
            n += len(x)
        if n:
            i, j = np.divmod(np.arange(BITS * BITS), BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, -1)), pa.array(np.append(j, -1)),
                 pa.array(np.append(total.reshape(-1), n).astype(np.int64))], names=["i", "j", "c"])

    rows = classes.select("_fp").mapInArrow(run, "i bigint, j bigint, c bigint") \
        .groupBy("i", "j").agg(F.sum("c").alias("c")).collect()  # 64 x 64 + 1 rows
    both, n = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r["i"] < 0:
            n = r["c"]
        else:
            both[r["i"], r["j"]] = r["c"]
    return n, both


def agreement(n: int, both: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints agree on bit i and on bit j (i = j: on that bit)."""
    p11 = both / max(n, 1)
    p1 = np.diag(p11)
    p10, p01 = p1[:, None] - p11, p1[None] - p11
    return p11 ** 2 + p10 ** 2 + p01 ** 2 + (1 - p11 - p10 - p01) ** 2 if n else np.ones((BITS, BITS))


def group_bits(agree: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near-equal width, each grown from a free bit by the free bits that go with it most."""
    one = np.diag(agree)
    tie = np.abs(agree - np.outer(one, one))
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: (tie[b, free].sum() - tie[b, b], -b))]
        free.remove(group[0])
        while len(group) < size:
            nxt = max(free, key=lambda b: (tie[b, group].max(), -b))
            group.append(nxt)
            free.remove(nxt)
        out.append(sorted(group))
    return out


def distance_chances(agree: np.ndarray, group: list[int], most: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0..most bits of the group.  Each bit depends on the
    bit before it in the group (a chain), as measured over all fingerprints."""
    state = np.zeros((2, most + 2))  # by whether the last bit differs, and the number of differing bits
    prev = None
    for b in group:
        same = float(agree[b, b])
        if prev is None:
            state[0, 0], state[1, 1] = same, 1 - same
        else:
            ps, joint = float(agree[prev, prev]), float(agree[prev, b])
            after_same = joint / ps if ps > 0 else same
            after_diff = (same - joint) / (1 - ps) if ps < 1 else same
            nxt = np.zeros_like(state)
            nxt[0] = state[0] * after_same + state[1] * after_diff
            moved = state[0] * (1 - after_same) + state[1] * (1 - after_diff)
            nxt[1, 1:] = moved[:-1]
            nxt[1, -1] += moved[-1]
            state = nxt
        prev = b
    return np.cumsum(state.sum(0))[:most + 1]


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost with sum(t + 1) = max_bits + 1; costs[i][t + 1] for t = -1, 0, ..."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for step, c in enumerate(row):
                if used + step <= max_bits + 1 and (used + step not in nxt or cost + c < nxt[used + step][0]):
                    nxt[used + step] = (cost + c, [*ts, step - 1])
        best = nxt
    return best[max_bits + 1]


def plan(n: int, both: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, the cheapest over all numbers of partitions up to max_bits + 1."""
    n = max(n, 1)
    agree, options = agreement(n, both), []
    for parts in range(1, max_bits + 2):
        groups = group_bits(agree, parts)
        costs = []
        for g in groups:
            near = distance_chances(agree, g, max_bits) * n * n / 2
            probes = np.cumsum([comb(len(g), t) for t in range(max_bits + 1)]) * n * 4.0  # a row costs more than a test
            costs.append([0.0, *(near + probes)])
        cost, ts = allocate(costs, max_bits)
        options.append((cost, [(g, t) for g, t in zip(groups, ts) if t >= 0]))
    return min(options, key=lambda x: x[0])[1]


# ---------------------------------------------------------------- probing and verifying

def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def deal(classes: DataFrame, partitions: list[tuple[list[int], int]]) -> DataFrame:
    """(_key, _free, _fp): a row for every value within t bits of the fingerprint in every partition.
    ``_free`` has the bits that members of a bucket need not share."""
    ways = []
    for k, (group, t) in enumerate(partitions):
        mask = _mask(group)
        flips = np.array([_signed(_mask(list(c))) for r in range(t + 1) for c in combinations(group, r)], np.int64)
        ways.append((k, np.int64(_signed(mask)), flips, _signed(((1 << 64) - 1) ^ (mask if t == 0 else 0))))

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for k, mask, flips, free in ways:
                for a in range(0, len(fp), max(1, (1 << 18) // len(flips))):
                    part = fp[a:a + max(1, (1 << 18) // len(flips))]
                    v = ((part & mask)[:, None] ^ flips).reshape(-1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), k)), pa.array(v), pa.array(np.full(len(v), free)),
                         pa.array(np.repeat(part, len(flips)))], names=["k", "v", "_free", "_fp"])

    return classes.select("_fp").mapInArrow(run, "k bigint, v bigint, _free bigint, _fp bigint") \
        .select(F.xxhash64("k", "v").alias("_key"), "_free", "_fp")


def deal_again(rows: DataFrame, max_bits: int) -> DataFrame:
    """Members of a large bucket, dealt by each of max_bits + 1 parts of the bits that are still free."""

    def run(batches):
        for batch in batches:
            key, free, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_key", "_free", "_fp"))
            out: list[list[np.ndarray]] = [[], [], [], []]
            for f in np.unique(free):
                at = np.flatnonzero(free == f)
                bits = np.flatnonzero(_bits(np.array([f]))[0])
                for j, part in enumerate(np.array_split(bits, max_bits + 1)):
                    m = np.int64(_signed(_mask(part.tolist())))
                    for o, v in zip(out, (key[at], np.full(len(at), j), fp[at] & m, np.full(len(at), f & ~m))):
                        o.append(v.astype(np.int64))
                out.append(fp[at])
            fps = np.concatenate([np.tile(x, max_bits + 1) for x in out[4:]]) if len(out) > 4 else np.zeros(0, np.int64)
            cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out[:4]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in [*cols, fps]], names=["k", "j", "v", "_free", "_fp"])

    dealt = rows.select("_key", "_free", "_fp").mapInArrow(run, "k bigint, j bigint, v bigint, _free bigint, _fp bigint")
    return dealt.select(F.xxhash64("k", "j", "v").alias("_key"), "_free", "_fp")


def verified_forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within max_bits among a bucket's distinct fingerprints."""
    fps, forest = np.unique(fps), []
    n = len(fps)
    uf, roots = UnionFind(n), np.arange(n)
    left = np.arange(n)
    while len(left):
        # breadth first from an unreached fingerprint: each member is compared with each once, at most
        seen, left = [int(left[0])], left[1:]
        while seen and len(left):
            x = seen.pop()
            near = np.bitwise_count((fps[left] ^ fps[x]).view(np.uint64)) <= max_bits
            for y in left[near].tolist():
                uf.union(x, y)
                forest.append((int(fps[x]), int(fps[y])))
                seen.append(y)
            left = left[~near]
    return forest


def links(classes: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints of ``classes._fp`` whose components are those of all
    pairs within ``max_bits`` bits."""
    bucket = max(bucket, 1 << max_bits)  # fewer free bits than parts: all members are within max_bits
    n, both = bit_counts(classes)
    rows = deal(classes, plan(n, both, max_bits))

    def run(batches):
        for batch in batches:
            found = [e for m in batch.column(0) for e in verified_forest(m.values.to_numpy(), max_bits)]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    out = []
    while True:
        sizes = materialize(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
        small = rows.join(sizes.where(F.col("n") <= bucket), "_key")
        out.append(small.groupBy("_key").agg(F.collect_list("_fp").alias("m")).select("m")  # at most ``bucket`` values
                   .mapInArrow(run, "a bigint, b bigint"))
        large = rows.join(sizes.where(F.col("n") > bucket).select("_key"), "_key", "left_semi")
        if sizes.where(F.col("n") > bucket).limit(1).count() == 0:
            break
        rows = materialize(deal_again(large, max_bits).distinct(), "simhash-dealt")
    both_ways = out[0]
    for more in out[1:]:
        both_ways = both_ways.unionAll(more)
    return both_ways


def simhash_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 3) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 lowercase hex digits), ``component_id`` (least id
    of all rows reachable by links of at most ``max_bits`` differing bits, itself included).

    Texts without words (null too) have fingerprint zero and link like any other.  A text of fewer
    words than a shingle has its whole sequence as one shingle.  Repeated rows are members of one class;
    null ids never name a component (null if a component has no other); other columns are not read."""
    prints = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "simhash-prints")
    classes = materialize(prints.groupBy("_fp").agg(F.min("_id").alias("_first")), "simhash-classes")
    found = components(links(classes, max_bits))
    rooted = classes.join(found, classes["_fp"] == found["node"], "left") \
        .select("_fp", "_first", F.coalesce("component", "_fp").alias("_root"))
    names = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = rooted.select("_fp", "_root").join(names, "_root").select("_fp", "component_id")
    return prints.join(named, "_fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")

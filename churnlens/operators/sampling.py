"""Deterministic splits, folds, class weights and scalers (SMP1-3, SCA1-2).

A row's place in any split depends only on a hash of (seed, key), never on
partitioning or row order, so a lost executor recomputes the same split.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.quantiles import kth_values

HASH_HEX = 13  # 52 bits: exact as a double, so order statistics over it stay exact


def hash_key(key: str = "username", seed: int = 42, word: int = 0):
    """Uniform 52-bit integer from md5(seed:key); ``word`` 1 gives a second, independent one."""
    hexs = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1 + word * HASH_HEX, HASH_HEX)
    return F.conv(hexs, 16, 10).cast("long")


def class_cuts(hashed: DataFrame, label: str, ranks: dict, counts: dict) -> dict:
    """(first word, second word) of the rows at the wanted 0-based ranks of each class in hash order.

    The first word is found by distributed order statistics; where several rows of a
    class share it, the second word is, among those rows.  Only cuts reach the driver.
    """
    wanted = {str(c): sorted(set(r)) for c, r in ranks.items() if r}
    if not wanted:
        return {}
    names = {str(c): c for c in ranks}
    cls = F.col(label).cast("string")
    first = kth_values(hashed.select(cls.alias("name"), F.col("_h").cast("double").alias("v")), wanted,
                       counts={str(c): n for c, n in counts.items()})
    spots = [(c, k, int(v)) for c, by in first.items() for k, v in by.items()]
    here = lambda c, v: (cls == F.lit(c)) & (F.col("_h") == F.lit(v))
    row = hashed.agg(*[x for i, (c, k, v) in enumerate(spots) for x in (
        F.count_if((cls == F.lit(c)) & (F.col("_h") < F.lit(v))).alias(f"b{i}"), F.count_if(here(c, v)).alias(f"n{i}"),
        F.min(F.when(here(c, v), F.col("_h2"))).alias(f"m{i}"))]).first()
    out, tied = {}, []
    for i, (c, k, v) in enumerate(spots):
        out[(names[c], k)] = (v, row[f"m{i}"])
        if row[f"n{i}"] > 1:
            tied.append((c, k, v, k - row[f"b{i}"]))
    for c, k, v, rank in tied:
        rows = hashed.where(here(c, v)).select(F.lit("x").alias("name"), F.col("_h2").cast("double").alias("v"))
        out[(names[c], k)] = (v, int(kth_values(rows, {"x": [rank]})["x"][rank]))
    return out


def _up_to(cut: tuple[int, int]):
    """Rows at or before a cut in hash order."""
    return (F.col("_h") < F.lit(cut[0])) | ((F.col("_h") == F.lit(cut[0])) & (F.col("_h2") <= F.lit(cut[1])))


def _hashed(df: DataFrame, label: str, key: str, seed: int) -> tuple[DataFrame, dict]:
    h = df.withColumn("_h", hash_key(key, seed)).withColumn("_h2", hash_key(key, seed, 1))
    return h, {r[label]: r["n"] for r in h.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_quotas(counts: dict[int, int], test_size: float = 0.2) -> dict[int, int]:
    """Test rows per class: train = ⌈…⌉ split of n, per-class floor + largest remainder."""
    n = sum(counts.values())
    if n == 0:
        return {c: 0 for c in counts}
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    cont = {c: n_train * k / n for c, k in counts.items()}
    fl = {c: math.floor(v) for c, v in cont.items()}
    need = n_train - sum(fl.values())
    order = sorted(counts, key=lambda c: (-(cont[c] - fl[c]), c))
    for c in order[:need]:
        fl[c] += 1
    return {c: counts[c] - fl[c] for c in counts}


def stratified_split(df: DataFrame, label: str = "churn", key: str = "username", test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``is_test``: each class sends exactly its quota of smallest-hash rows to test.

    The cut per class is an exact order statistic found by distributed bracket
    search over two hash words, so ties need no comparison by key; rows that repeat a key
    stay on one side.
    """
    h, counts = _hashed(df, label, key, seed)
    quotas = {c: q for c, q in class_quotas(counts, test_size).items() if q > 0}
    cuts = class_cuts(h, label, {c: [q - 1] for c, q in quotas.items()}, counts)
    cond = F.lit(False)
    for c, q in quotas.items():
        cond = cond | ((F.col(label) == F.lit(c)) & _up_to(cuts[(c, q - 1)]))
    return h.withColumn("is_test", cond).drop("_h", "_h2")


def kfold_assignment(df: DataFrame, k: int = 5, key: str = "username", seed: int = 42, label: str = "churn") -> DataFrame:
    """Adds ``fold`` in 0..k-1, stratified: each class is cut into k runs of its hash order whose sizes
    differ by one at most."""
    h, counts = _hashed(df, label, key, seed)
    # fold f of a class of n rows holds the ranks r with floor(r k / n) = f
    lasts = {c: {f: -(-(f + 1) * n // k) - 1 for f in range(k - 1)} for c, n in counts.items()}
    cuts = class_cuts(h, label, {c: [r for r in by.values() if r >= 0] for c, by in lasts.items()}, counts)
    fold = F.lit(0)
    for c, by in lasts.items():
        here = F.lit(k - 1)
        for f in sorted(by, reverse=True):
            if by[f] >= 0:
                here = F.when(_up_to(cuts[(c, by[f])]), F.lit(f)).otherwise(here)
        same = F.col(label).isNull() if c is None else F.col(label) == F.lit(c)
        fold = F.when(same, here).otherwise(fold)
    return h.withColumn("fold", fold.cast("int")).drop("_h", "_h2")


def class_weights(df: DataFrame, label: str = "churn") -> DataFrame:
    """Balanced weight per class: n / (classes · n_class); one row per class."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    from pyspark.sql import Window
    w = Window.partitionBy()
    return g.select(label, "n_class",
                    (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "churn", weight_col: str = "weight") -> DataFrame:
    """Attach the class weight to each row, as a literal map from the classes that a classifier tells apart."""
    out = F.lit(None).cast("double")
    for r in class_weights(df, label).collect():
        same = F.col(label).isNull() if r[label] is None else F.col(label) == F.lit(r[label])
        out = F.when(same, F.lit(float(r["weight"]))).otherwise(out)
    return df.withColumn(weight_col, out)


def fit_standard(df: DataFrame, cols) -> dict[str, tuple[float, float]]:
    """Population mean and std per column (a zero std scales by 1)."""
    r = df.agg(*[F.avg(c).alias(f"m__{c}") for c in cols], *[F.stddev_pop(c).alias(f"s__{c}") for c in cols]).first()
    return {c: (r[f"m__{c}"], (r[f"s__{c}"] or 0.0) if (r[f"s__{c}"] or 0.0) > 0 else 1.0) for c in cols}


def apply_standard(df: DataFrame, stats: dict, keep=()) -> DataFrame:
    cols = [F.col(k) for k in keep] + [((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, (m, s) in stats.items()]
    return df.select(*cols)


def fit_minmax(df: DataFrame, cols) -> dict[str, tuple[float, float]]:
    r = df.agg(*[F.min(c).alias(f"lo__{c}") for c in cols], *[F.max(c).alias(f"hi__{c}") for c in cols]).first()
    return {c: (r[f"lo__{c}"], r[f"hi__{c}"]) for c in cols}


def apply_minmax(df: DataFrame, stats: dict, keep=()) -> DataFrame:
    """(x − min) / (max − min); a constant column maps to 0."""
    cols = [F.col(k) for k in keep]
    for c, (lo, hi) in stats.items():
        rng = (hi - lo) if (hi is not None and lo is not None and hi > lo) else 1.0
        cols.append(((F.col(c) - F.lit(lo)) / F.lit(rng)).alias(c))
    return df.select(*cols)

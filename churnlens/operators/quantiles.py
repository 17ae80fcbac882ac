"""Exact order statistics without pulling a column into one task or the driver.

``F.median`` / ``F.percentile`` keep every distinct value of a group in one
aggregation buffer, which does not survive a billion-row column.  Here one wide pass
builds a mergeable quantile sketch (KLL) per column, from which a bracket around every
wanted rank follows.  A closing pass counts the rows below each bracket and sketches
the rows inside it; a sketch over no more values than its ``k`` holds them all, so
a bracket of that size is closed exactly.  A larger one is narrowed
again by its own sketch, reading only rows inside an open bracket.  A pass shrinks a
bracket some hundredfold, so a column of up to 400 000 rows takes two passes and one of
10^10 rows four.

Partial results meet in two levels (task, seat, all), so no task merges the sketches of
every input partition.  The driver sees a sketch per column or bracket (some 50 kB each) and
a few numbers.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SKETCH_K = 4096
SEATS = 256

#: How a partial result of the first level is merged by the second.
Partial = tuple[Column, str]
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def tree_aggregate(df: DataFrame, partials: dict[str, Partial], sketches: dict[str, Column], k: int = SKETCH_K) -> Row:
    """One row: each partial aggregate merged by its rule, and a sketch of each column's values.

    Partitions are dealt to ``SEATS`` groups, whose results are merged in the end."""
    seated = df.withColumn("_seat", F.pmod(F.spark_partition_id(), F.lit(SEATS)))
    first = seated.groupBy("_seat").agg(*[c.alias(n) for n, (c, _) in partials.items()],
                                        *[F.kll_sketch_agg_double(c, F.lit(k)).alias(n) for n, c in sketches.items()])
    return first.agg(*[_MERGE[how](n).alias(n) for n, (_, how) in partials.items()],
                     *[F.kll_merge_agg_double(n, F.lit(k)).alias(n) for n in sketches]).first()


def _from_sketches(spark: SparkSession, asked: list[tuple[bytes, list[float]]]) -> list[list[float]]:
    """Quantiles of each sketch; evaluated on literals, without a job."""
    if not asked:
        return []
    row = spark.createDataFrame([tuple(bytearray(s) for s, _ in asked)],
                                ", ".join(f"s{i} binary" for i in range(len(asked))))
    return list(row.select(*[F.kll_sketch_get_quantile_double(f"s{i}", F.array(*[F.lit(float(f)) for f in fs])).alias(f"q{i}")
                             for i, (_, fs) in enumerate(asked)]).first())


class _Bracket:
    """Ranks of a column that lie in [lo, hi]: ``below`` rows are less than lo and ``size`` inside."""

    __slots__ = ("name", "ranks", "lo", "hi", "below", "size", "sketch")

    def __init__(self, name, ranks, lo, hi, below, size, sketch=None):
        self.name, self.ranks, self.lo, self.hi = name, ranks, lo, hi
        self.below, self.size, self.sketch = below, size, sketch

    def inside(self, v: Column) -> Column:
        return v.between(F.lit(self.lo), F.lit(self.hi))


def _clusters(ranks: list[int], width: float) -> list[list[int]]:
    """Ranks that lie within ``width`` rows of each other share a bracket."""
    out: list[list[int]] = []
    for r in sorted(set(ranks)):
        if out and r - out[-1][0] <= width:
            out[-1].append(r)
        else:
            out.append([r])
    return out


def order_statistics(df: DataFrame, columns: dict[str, Column], wanted: dict[str, list[int]] | Callable[[str, int, Row], list[int]],
                     k: int = SKETCH_K, first: dict[str, Partial] | None = None,
                     second: Callable[[Row], dict[str, Partial]] | None = None) -> tuple[dict[str, dict[int, float]], Row, Row | None]:
    """Exact 0-based k-th smallest non-null value per column, for the ranks in ``wanted`` (a table, or a
    function of the column's name, its number of values and the first pass's row).

    ``columns`` are double expressions without NaN or infinities; null is no value.  ``first`` are more
    aggregates of the first pass and ``second`` (from the first pass's row) of the second one, so that a
    caller's statistics need no pass of their own.  Returns ({name: {rank: value}}, first row, second row)."""
    spark, names = df.sparkSession, list(columns)
    if not names:
        row = tree_aggregate(df, first, {}) if first else Row()
        return {}, row, tree_aggregate(df, second(row), {}) if second else None
    # 0.0 and -0.0 are one value, for the sketch too
    values = {n: (c + F.lit(0.0)).alias(f"_v{i}") for i, (n, c) in enumerate(columns.items())}
    col = {n: F.col(f"_v{i}") for i, n in enumerate(names)}
    rows = df.select("*", *values.values())
    at = {n: str(i) for i, n in enumerate(names)}
    row1 = tree_aggregate(rows, {**(first or {}), **{f"_n{at[n]}": (F.count(col[n]), "sum") for n in names}},
                          {f"_s{at[n]}": col[n] for n in names}, k)
    eps = min(0.5, 8.0 / k ** 0.9)  # several times the sketch's rank error
    out: dict[str, dict[int, float]] = {n: {} for n in names}
    todo = []
    for n in names:
        count = row1[f"_n{at[n]}"] or 0
        ranks = wanted(n, count, row1) if callable(wanted) else wanted.get(n, [])
        for r in ranks:
            if not 0 <= r < count:
                raise ValueError(f"rank {r} outside 0..{count - 1} for {n!r}")
        for some in _clusters(ranks, max(1.0, eps * count)):
            todo.append(_Bracket(n, some, None, None, 0, count, row1[f"_s{at[n]}"]))
    row2, pass_no = None, 1
    while True:
        todo = _narrow(spark, todo, out, eps, k)
        if not todo and (second is None or pass_no > 1):
            return out, row1, row2
        pass_no += 1
        seen = rows
        if pass_no > 2:  # later passes read rows of open brackets only, and count from their lower ends
            cond = F.lit(False)
            for b, *_ in todo:
                cond = cond | b.inside(col[b.name])
            seen = rows.where(cond)
        partials = dict(second(row1)) if second and pass_no == 2 else {}
        sketches = {}
        for i, (b, lo, hi) in enumerate(todo):
            v = col[b.name]
            held = F.lit(True) if b.lo is None else b.inside(v)
            partials[f"_a{i}"] = (F.count_if(held & (v < F.lit(lo))), "sum")
            partials[f"_b{i}"] = (F.count_if(held & (v <= F.lit(hi))), "sum")
            sketches[f"_s{i}"] = F.when(v.between(F.lit(lo), F.lit(hi)), v)
        got = tree_aggregate(seen, partials, sketches, k)
        if pass_no == 2:
            row2 = got
        todo = [part for i, (b, lo, hi) in enumerate(todo)
                for part in _cut(b, lo, hi, b.below + (got[f"_a{i}"] or 0), b.below + (got[f"_b{i}"] or 0), got[f"_s{i}"])]


def _narrow(spark, brackets: list[_Bracket], out: dict, eps: float, k: int) -> list[tuple[_Bracket, float, float]]:
    """Closes brackets that are exact; gives new bounds for the others from their sketches."""
    asked, exact, todo = [], [], []
    for b in brackets:
        if b.lo is not None and b.lo == b.hi:
            out[b.name].update({r: b.lo for r in b.ranks})
            continue
        if b.sketch is None:  # what a cut left beside it: to be sketched as it is
            todo.append((b, b.lo, b.hi))
            continue
        whole = b.size <= k
        if whole:
            fs = [(r - b.below + 0.5) / b.size for r in b.ranks]
        else:
            lo, hi = (b.ranks[0] - b.below) / b.size, (b.ranks[-1] - b.below + 1) / b.size
            fs = [max(0.0, lo - eps), (lo + hi) / 2, min(1.0, hi + eps)]
        asked.append((b.sketch, fs))
        exact.append((b, whole))
    for (b, whole), q in zip(exact, _from_sketches(spark, asked)):
        if whole:
            out[b.name].update(dict(zip(b.ranks, q)))
            continue
        lo, mid, hi = q
        if (lo, hi) == (b.lo, b.hi):  # the sketch does not part the bracket: one value does
            lo = hi = mid
        todo.append((b, lo, hi))
    return todo


def _cut(b: _Bracket, lo: float, hi: float, below: int, upto: int, sketch: bytes) -> list[_Bracket]:
    """The bracket's ranks by where they turn out to lie: below, inside or above [lo, hi]."""
    parts = []
    less = [r for r in b.ranks if r < below]
    here = [r for r in b.ranks if below <= r < upto]
    more = [r for r in b.ranks if r >= upto]
    if here:
        parts.append(_Bracket(b.name, here, lo, hi, below, upto - below, sketch))
    # rare: the sketch erred by more than eps, or one value was taken out of the middle
    if less:
        parts.append(_Bracket(b.name, less, b.lo if b.lo is not None else -_MOST, math.nextafter(lo, -math.inf),
                              b.below, below - b.below, None))
    if more:
        parts.append(_Bracket(b.name, more, math.nextafter(hi, math.inf), b.hi if b.hi is not None else _MOST,
                              upto, b.below + b.size - upto, None))
    return parts


def finite(c: Column) -> Column:
    """The value as a double; null for NaN and infinities."""
    d = c.cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def _long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    """(name, v) rows for the non-null, finite values of ``cols``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), finite(F.col(c)).alias("v")) for c in cols])
    return df.select(F.inline(pairs)).where(F.col("v").isNotNull())


def kth_values(long_df: DataFrame, wanted: dict[str, list[int]], key: str = "name", value: str = "v",
               counts: dict[str, int] | None = None, accuracy: int = SKETCH_K) -> dict[str, dict[int, float]]:
    """Exact 0-based k-th smallest ``value`` per ``key`` of (key, value) rows without nulls, for the ranks
    in ``wanted``; ``counts`` (rows per key) is checked against the ranks before a pass is made."""
    for g, ranks in wanted.items():
        for r in ranks:
            if counts is not None and not 0 <= r < counts.get(g, 0):
                raise ValueError(f"rank {r} outside 0..{counts.get(g, 0) - 1} for {g!r}")
    columns = {g: F.when(F.col(key) == F.lit(g), F.col(value)) for g in wanted}
    return order_statistics(long_df, columns, wanted, k=max(8, accuracy))[0]


def quantile_ranks(probs: list[float]) -> Callable[[str, int, Row], list[int]]:
    """The ranks that linear interpolation at ``probs`` needs."""
    return lambda _name, n, _row: sorted({f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)}) if n else []


def interpolate(values: dict[int, float], n: int, probs: list[float]) -> list[float | None]:
    """Linear-interpolated quantiles (pandas / DuckDB ``quantile_cont`` rule) from order statistics."""
    if not n:
        return [None] * len(probs)
    out = []
    for p in probs:
        at = p * (n - 1)
        a, b = values[math.floor(at)], values[math.ceil(at)]
        out.append(a + (b - a) * (at - math.floor(at)))
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Interpolated quantiles per column; NULL, NaN and ±Inf are skipped, a column without values yields None."""
    counts = {f"n_{i}": (F.count(finite(F.col(c))), "sum") for i, c in enumerate(cols)}
    values, row, _ = order_statistics(df, {c: finite(F.col(c)) for c in cols}, quantile_ranks(probs), first=counts)
    return {c: interpolate(values[c], row[f"n_{i}"] or 0, probs) for i, c in enumerate(cols)}


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5]).items()}


_MOST = sys.float_info.max

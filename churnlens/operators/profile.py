"""Profiling aggregates (AGG5-AGG16).

Every statistic is one global aggregate (partial aggregation on each task,
one row merged at the end) followed by an ``unpivot`` of that single row, so
the cost is one scan regardless of the number of users.  Quartiles use the
distributed exact order statistics in :mod:`churnlens.operators.quantiles`.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.quantiles import finite, interpolate, order_statistics, quantile_ranks
from churnlens.session import materialize


def null_profile(df: DataFrame, only_gappy: bool = True) -> DataFrame:
    """Per column: missing count and percentage (columns with gaps only by default)."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot("_n", cols, "field", "null_count")
    out = long.select("field", F.col("null_count").cast("long").alias("null_count"),
                      F.when(F.col("_n") > 0, F.col("null_count") * 100.0 / F.col("_n"))
                       .otherwise(F.lit(0.0)).alias("null_pct"))
    return out.where(F.col("null_count") > 0) if only_gappy else out


def column_profile(df: DataFrame) -> DataFrame:
    """Column name, Spark type and non-null count (the ``info()`` table)."""
    cols = df.columns
    one = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    long = one.unpivot([], cols, "field", "non_null")
    type_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return long.select("field", type_map[F.col("field")].alias("dtype"),
                       F.col("non_null").cast("long").alias("non_null"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (interpolated), max per column.

    NULL and NaN are skipped as in the reference, and quartiles skip ±Inf too.  The moments share the two
    passes of the order statistics: sums and extremes come with the sketches, squared distances from the
    mean with the counts that close the brackets.
    """
    spark, probs = df.sparkSession, [0.25, 0.5, 0.75]
    # NaN counts as missing (as in pandas); Spark's count/avg would include it
    dbl = df.select(*[F.when(F.isnan(F.col(c).cast("double")), F.lit(None)).otherwise(F.col(c).cast("double"))
                      .alias(c) for c in cols])
    first = {}
    for i, c in enumerate(cols):
        first |= {f"count{i}": (F.count(c), "sum"), f"sum{i}": (F.sum(c), "sum"), f"min{i}": (F.min(c), "min"),
                  f"max{i}": (F.max(c), "max"), f"finite{i}": (F.count(finite(F.col(c))), "sum")}

    def mean(row, i):
        return row[f"sum{i}"] / row[f"count{i}"] if row[f"count{i}"] else None

    def second(row):
        return {f"m2{i}": (F.sum((F.col(c) - F.lit(mean(row, i))) * (F.col(c) - F.lit(mean(row, i)))), "sum")
                for i, c in enumerate(cols) if row[f"count{i}"]}

    values, one, two = order_statistics(dbl, {c: finite(F.col(c)) for c in cols}, quantile_ranks(probs), first=first, second=second)
    rows = []
    for i, c in enumerate(cols):
        n = one[f"count{i}"] or 0
        std = math.sqrt(two[f"m2{i}"] / (n - 1)) if n > 1 else None
        rows.append((c, n, mean(one, i) if n else None, std, one[f"min{i}"],
                     *interpolate(values[c], one[f"finite{i}"] or 0, probs), one[f"max{i}"]))
    schema = "field string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    return spark.createDataFrame(rows, schema)


def means_by_label(df: DataFrame, cols: list[str], label: str = "churn") -> DataFrame:
    """Mean of every column per label value, long form (label, feature, mean)."""
    g = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])
    return g.unpivot(label, cols, "feature", "mean")


def histogram(df: DataFrame, cols: list[str], bins: int = 40, by: str | None = None) -> DataFrame:
    """Equal-width histogram per column (and per ``by`` value) over the column's range.

    With ``by`` (a low-cardinality label), every group gets its own range, as
    one histogram call per group would.  Bin i covers [lo + i·w, lo + (i+1)·w); the maximum lands in the last bin.
    A constant column is spread over [v − 0.5, v + 0.5] as numpy does.  Empty
    bins are not listed.  Ranges are one aggregate, written and joined (broadcast where small); values are
    counted by (column, bin) with map-side combining, so only counts are shuffled.
    """
    keys = [by] if by else []
    long = (df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v")) for c in cols])))
        .where(F.col("v").isNotNull() & ~F.isnan("v")))
    rng = long.groupBy(*keys, "field").agg(F.min("v").alias("vmin"), F.max("v").alias("vmax"))
    # written, so that the planner knows its size before it chooses how to join: tiny unless ``by`` has many values
    rng = materialize(rng.select(*keys, "field",
                     F.when(F.col("vmin") == F.col("vmax"), F.col("vmin") - 0.5).otherwise(F.col("vmin")).alias("lo"),
                     F.when(F.col("vmin") == F.col("vmax"), F.col("vmax") + 0.5).otherwise(F.col("vmax")).alias("hi")), "histogram-ranges")
    j = long.join(rng, [*keys, "field"])
    b = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(bins)).cast("int"),
                F.lit(bins - 1))
    w = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return (j.groupBy(*keys, "field", b.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
            .select(*keys, "field", "bin",
                    (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                    "count"))


def matrix_health(pre_fill: DataFrame, filled: DataFrame, cols: list[str]) -> DataFrame:
    """Per feature: missing values before the fill, NaN and ±Inf after it."""
    a = pre_fill.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).unpivot([], cols, "feature", "missing_before_fill")
    inf = F.lit(float("inf"))
    b = filled.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(f"{c}__nan") for c in cols],
                   *[F.count_if(F.abs(F.col(c)) == inf).alias(f"{c}__inf") for c in cols])
    b = b.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"),
                                               F.col(f"{c}__nan").alias("nan_after"),
                                               F.col(f"{c}__inf").alias("inf_after")) for c in cols])))
    return a.join(b, "feature").select("feature", F.col("missing_before_fill").cast("long"),
                                        F.col("nan_after").cast("long"), F.col("inf_after").cast("long"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every ordered pair (a, b) from one pass of co-moment aggregates.

    A zero-variance column gives NULL (pandas gives NaN; both compare false).
    """
    aggs = []
    for i, a in enumerate(cols):
        aggs.append(F.stddev_pop(a).alias(f"s__{i}"))
        for j in range(i, len(cols)):
            aggs.append(F.covar_pop(a, cols[j]).alias(f"c__{i}__{j}"))
    one = df.agg(*aggs)
    items = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            den = F.col(f"s__{i}") * F.col(f"s__{j}")
            r = F.when(den > 0, F.col(f"c__{lo}__{hi}") / den)
            items.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(i).alias("ia"),
                                  F.lit(j).alias("ib"), r.alias("r")))
    out = one.select(F.inline(F.array(*items)))
    return out.select("a", "b", "ia", "ib", "r", F.abs("r").alias("abs_r"))


def confusion(df: DataFrame, label: str = "churn", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, tn, fn counts."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "churn", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1 for class 1; a zero denominator gives 0."""
    c = confusion(df, label, prediction)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    prec, rec = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    return c.select("tp", "fp", "tn", "fn",
                    _safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def classification_report(df: DataFrame, label: str = "churn", prediction: str = "prediction",
                          names=("Retained", "Churned")) -> DataFrame:
    """Per-class precision / recall / F1 / support, plus accuracy, macro and weighted rows."""
    c = confusion(df, label, prediction)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    # class 0 views the matrix the other way round
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_1, f1_0 = _safe_div(2 * tp, 2 * tp + fp + fn), _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _safe_div(tp + tn, n)
    rows = [
        (names[0], p0, r0, f1_0, s0),
        (names[1], p1, r1, f1_1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        ("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
         _safe_div(f1_0 * s0 + f1_1 * s1, n), n),
    ]
    arr = F.array(*[F.struct(F.lit(nm).alias("class"), p.alias("precision"), r.alias("recall"),
                             f.alias("f1"), s.cast("long").alias("support")) for nm, p, r, f, s in rows])
    return c.select(F.inline(arr))


def summarize_features(pre_fill: DataFrame, filled: DataFrame, cols, label: str | None = "churn") -> dict:
    """The feature summary: describe, matrix health and (when labelled) means by label."""
    out = {"describe": describe(filled, cols), "health": matrix_health(pre_fill, filled, cols)}
    if label and label in filled.columns:
        out["means_by_label"] = means_by_label(filled, cols, label)
    return out


def feature_summary(pre_fill: DataFrame, filled: DataFrame, cols, label: str = "churn", classes=(0, 1)) -> DataFrame:
    """The parts of :func:`summarize_features` side by side, one row per feature: its statistics, its missing and
    odd values, and its mean for each class of the label.  Every part has a row per feature, so the joins are small."""
    parts = summarize_features(pre_fill, filled, cols, label)
    out = parts["describe"].withColumnRenamed("field", "feature").join(parts["health"], "feature")
    means = parts["means_by_label"].groupBy("feature").agg(
        *[F.max(F.when(F.col(label) == F.lit(c), F.col("mean"))).alias(f"mean_{c}") for c in classes])
    return out.join(means, "feature", "left")

"""Filter-method feature selection (SEL1-SEL4, WIN1).

All three filters read the user rows once each through a global or per-label
aggregate; everything after that is a join of 10-row frames (one row per
feature), so it costs the same at any user count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.profile import correlation_matrix
from churnlens.schemas import FEATURE_COLUMNS

VARIANCE_THRESHOLD = 0.01
CORR_THRESHOLD = 0.9
TOP_K = 5


def _ordinals(spark, cols) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature string, ordinal int")


def variance_filter(df: DataFrame, cols=FEATURE_COLUMNS, threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    """Population variance per feature and whether it is strictly above the threshold."""
    one = df.agg(*[F.var_pop(c).alias(c) for c in cols])
    long = one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ordinal"), F.col(c).alias("variance"))
        for i, c in enumerate(cols)])))
    return long.withColumn("variance_kept", F.coalesce(F.col("variance") > F.lit(threshold), F.lit(False)))


def anova_scores(df: DataFrame, cols=FEATURE_COLUMNS, label: str = "churn") -> DataFrame:
    """One-way ANOVA F per feature between label groups, ranked (WIN1).

    From per-group count, mean and population variance (numerically stable):
    SSB = Σ n_g (mean_g − mean)², SSW = Σ n_g var_g, F = (SSB/(k−1)) / (SSW/(n−k)).
    A feature without within-group spread gets NULL (ranked last).
    """
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                              *[F.avg(c).alias(f"m__{c}") for c in cols],
                              *[F.var_pop(c).alias(f"v__{c}") for c in cols])
    long = g.select(label, "n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ordinal"),
                 F.col(f"m__{c}").alias("m"), F.col(f"v__{c}").alias("v")) for i, c in enumerate(cols)])))
    tot = long.groupBy("feature", "ordinal").agg(
        F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("k"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    j = long.join(tot, ["feature", "ordinal"])
    s = j.groupBy("feature", "ordinal", "n_all", "k").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"))
    f = F.when((F.col("ssw") > 0) & (F.col("k") > 1) & (F.col("n_all") > F.col("k")),
               (F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("n_all") - F.col("k"))))
    w = Window.orderBy(F.desc_nulls_last("f_score"), "ordinal")
    return (s.select("feature", "ordinal", f.alias("f_score"))
            .withColumn("anova_rank", F.row_number().over(w)))


def correlation_pairs(df: DataFrame, scores: DataFrame, survivors: DataFrame | None = None,
                      cols=FEATURE_COLUMNS, threshold: float = CORR_THRESHOLD) -> DataFrame:
    """Pairs i < j with |r| > threshold and the member to drop.

    The loser is the lower F-score; on a tie (or an undefined F) the later
    feature.  Every pair is judged, so the result does not depend on order.
    Only variance survivors take part when ``survivors`` is given.
    """
    cm = correlation_matrix(df, cols).where((F.col("ia") < F.col("ib")) & (F.col("abs_r") > F.lit(threshold)))
    if survivors is not None:
        keep = survivors.select(F.col("feature"))
        cm = (cm.join(keep.withColumnRenamed("feature", "a"), "a", "left_semi")
              .join(keep.withColumnRenamed("feature", "b"), "b", "left_semi"))
    fa = scores.select(F.col("feature").alias("a"), F.col("f_score").alias("f_a"))
    fb = scores.select(F.col("feature").alias("b"), F.col("f_score").alias("f_b"))
    p = cm.join(fa, "a").join(fb, "b")
    return p.select("a", "b", "abs_r", "f_a", "f_b",
                    F.when(F.col("f_a") < F.col("f_b"), F.col("a")).otherwise(F.col("b")).alias("dropped"))


def filter_method(df: DataFrame, cols=FEATURE_COLUMNS, label: str = "churn", top_k: int = TOP_K,
                  var_threshold: float = VARIANCE_THRESHOLD, corr_threshold: float = CORR_THRESHOLD) -> DataFrame:
    """Per feature: variance kept, correlation kept, ANOVA rank / top-k, final filter choice.

    ANOVA ranks every feature (as ``SelectKBest(k='all')`` on the full matrix);
    the correlation step only sees variance survivors and uses F-scores
    computed on them (same values: F is per feature).
    """
    var = variance_filter(df, cols, var_threshold)
    scores = anova_scores(df, cols, label)
    survivors = var.where("variance_kept").select("feature")
    pairs = correlation_pairs(df, scores, survivors, cols, corr_threshold)
    dropped = pairs.select(F.col("dropped").alias("feature")).distinct().withColumn("corr_dropped", F.lit(True))
    out = (var.join(scores.drop("ordinal"), "feature")
           .join(dropped, "feature", "left")
           .select("feature", "ordinal", "variance", "variance_kept", "f_score", "anova_rank",
                   (F.col("variance_kept") & F.col("corr_dropped").isNull()).alias("corr_kept"),
                   (F.col("anova_rank") <= F.lit(top_k)).alias("anova_top")))
    return out.withColumn("filter_final", F.col("corr_kept") & F.col("anova_top"))

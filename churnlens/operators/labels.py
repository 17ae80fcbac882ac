"""Flattening, inactivity labels and label shares (SRC3, AGG1, LBL1, AGG2-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.scalars import days_since, parse_ts

DEFAULT_THRESHOLD = 365


def last_push(repos: DataFrame) -> DataFrame:
    """Latest valid push instant per owner (junk / null dates ignored).

    A plain ``max`` aggregate: partial aggregation runs before the shuffle on
    ``owner``, so an owner with a third of all repos costs one row per map task.
    """
    return (repos.select("owner", parse_ts("pushed_at").alias("_p"))
            .groupBy("owner").agg(F.max("_p").alias("last_pushed_at")))


def user_accounts(profiles: DataFrame) -> DataFrame:
    """Keep individual accounts (``type = 'User'``); organisations and NULL types drop."""
    return profiles.where(F.col("type") == "User")


def parse_users(profiles: DataFrame, repos: DataFrame | None, as_of) -> DataFrame:
    """Profiles (+ optional repos) → flat raw-user rows with the two day counts.

    ``repos=None`` means repositories were not fetched: ``days_since_last_push``
    is NULL and the label falls back to the profile update date.
    """
    base = profiles.select(
        F.col("login").alias("username"),
        "public_repos", "public_gists", "followers", "following",
        "created_at", "updated_at", "bio", "blog", "company", "email", "hireable",
    )
    if repos is not None:
        lp = last_push(repos).withColumnRenamed("owner", "username")
        base = base.join(lp, "username", "left")
    else:
        base = base.withColumn("last_pushed_at", F.lit(None).cast("timestamp"))
    return (base
            .withColumn("days_since_update", days_since(parse_ts("updated_at"), as_of))
            .withColumn("days_since_last_push", days_since(F.col("last_pushed_at"), as_of))
            .drop("last_pushed_at"))


def churn_label(threshold_days: int = DEFAULT_THRESHOLD):
    """1 when the push recency (else the update recency) exceeds the threshold; unknown → 0."""
    days = F.coalesce(F.col("days_since_last_push"), F.col("days_since_update"))
    return F.when(days > F.lit(int(threshold_days)), F.lit(1)).otherwise(F.lit(0))


def assign_labels(raw: DataFrame, threshold_days: int = DEFAULT_THRESHOLD) -> DataFrame:
    return raw.withColumn("churn", churn_label(threshold_days))


def raw_users(profiles: DataFrame, repos: DataFrame | None, as_of,
              threshold_days: int = DEFAULT_THRESHOLD) -> DataFrame:
    """User accounts → flat rows → label (the raw-user table, FIXTURES §1.3)."""
    return assign_labels(parse_users(user_accounts(profiles), repos, as_of), threshold_days)


def churn_ratio(df: DataFrame) -> DataFrame:
    """One row: share of churned users; 0.0 for an empty input."""
    return df.agg(F.coalesce(F.avg(F.col("churn").cast("double")), F.lit(0.0)).alias("churn_ratio"))


def churn_ratio_value(df: DataFrame) -> float:
    if "churn" not in df.columns:
        return 0.0
    return float(churn_ratio(df).first()["churn_ratio"])


def label_summary(df: DataFrame, min_churn_ratio: float = 0.10) -> DataFrame:
    """Totals, shares and pass/fail against the minimum share, one row."""
    n = F.count(F.lit(1))
    churned = F.coalesce(F.sum("churn"), F.lit(0)).cast("long")
    agg = df.agg(n.alias("total"), churned.alias("churned"))
    share = F.when(F.col("total") > 0, F.col("churned") / F.col("total")).otherwise(F.lit(0.0))
    return agg.select(
        "total", "churned",
        (F.col("total") - F.col("churned")).alias("retained"),
        share.alias("churned_share"),
        F.when(F.col("total") > 0, (F.col("total") - F.col("churned")) / F.col("total"))
         .otherwise(F.lit(0.0)).alias("retained_share"),
        (share >= F.lit(float(min_churn_ratio))).alias("passed"),
    )


def label_distribution(df: DataFrame) -> DataFrame:
    """Count and share of each label value (two rows at most).

    The share divides by a global sum taken over the grouped result, which has
    one row per label, so the window never sees user rows.
    """
    counts = df.groupBy("churn").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    return counts.select("churn", "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def label_sources(df: DataFrame) -> DataFrame:
    """Which signal decided each label: push date, update-date fallback, or none (→ 0).

    The fallback date is also the source of the recency feature, so its share
    measures how much the label and that feature overlap.
    """
    src = (F.when(F.col("days_since_last_push").isNotNull(), F.lit("push"))
           .when(F.col("days_since_update").isNotNull(), F.lit("update"))
           .otherwise(F.lit("none")))
    from pyspark.sql import Window
    g = df.groupBy(src.alias("label_source")).agg(F.count(F.lit(1)).alias("n"),
                                                   F.coalesce(F.sum("churn"), F.lit(0)).cast("long").alias("churned"))
    return g.select("label_source", "n", "churned", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))

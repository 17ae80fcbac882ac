"""The ten derived features (F1-F10), median fill and the (X, y) frame (AGG17).

One narrow projection computes every feature per user; one small aggregate
finds which columns hold missing values and a distributed exact median is taken
only for those.  The medians (a handful of doubles) are folded back in as
literals, so the final frame is again a single projection of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.scalars import (
    clean_count, days_since, finite_or_null, parse_ts, safe_years, text_present,
)
from churnlens.operators.quantiles import interpolate, order_statistics, quantile_ranks
from churnlens.schemas import FEATURE_COLUMNS, REQUIRED_RAW, require_columns
from churnlens.session import materialize

TEXT_FIELDS = ["bio", "blog", "company"]


def feature_columns(df: DataFrame, as_of) -> dict:
    """Column expressions for F1-F10 over a raw-user frame (before median fill)."""
    repos = clean_count("public_repos")
    followers = clean_count("followers")
    following = clean_count("following")
    gists = clean_count("public_gists") if "public_gists" in df.columns else F.lit(0.0)

    updated = parse_ts("updated_at")
    created = parse_ts("created_at")
    age_days = days_since(created, as_of).cast("double")
    years = safe_years(age_days)

    completeness = F.lit(0)
    for c in TEXT_FIELDS:
        if c in df.columns:
            completeness = completeness + text_present(c)
    if "hireable" in df.columns:
        completeness = completeness + F.col("hireable").isNotNull().cast("int")
    completeness = completeness.cast("double")

    per_year = repos / years
    return {
        "follower_ratio": followers / (following + F.lit(1.0)),
        "engagement_ratio": (followers + following) / (repos + F.lit(1.0)),
        "days_since_last_activity": days_since(updated, as_of).cast("double"),
        "account_age_days": age_days,
        "activity_frequency": per_year,
        "repos_per_year": per_year,
        "social_volume": F.log1p(followers + following + gists),
        "profile_completeness": completeness,
        "has_no_repos": (repos == F.lit(0.0)).cast("int"),
        "has_complete_profile": (completeness == F.lit(4.0)).cast("int"),
    }


def raw_feature_frame(raw: DataFrame, as_of, key: str = "username") -> DataFrame:
    """Key + ten features with NaN/±Inf turned to NULL (+ churn when present)."""
    require_columns(raw, REQUIRED_RAW, "generate_features()")
    exprs = feature_columns(raw, as_of)
    cols = [F.col(key)] if key in raw.columns else []
    for name in FEATURE_COLUMNS:
        e = exprs[name]
        if name not in ("has_no_repos", "has_complete_profile"):
            e = finite_or_null(e)
        cols.append(e.alias(name))
    if "churn" in raw.columns:
        cols.append(F.col("churn").cast("int").alias("churn"))
    return raw.select(*cols)


def fill_values(frame: DataFrame) -> dict[str, float]:
    """Per-column fill value for columns with missing entries: median, else 0.0."""
    doubles = [c for c in FEATURE_COLUMNS if c not in ("has_no_repos", "has_complete_profile")]
    # missing and present counts come with the first pass of the medians (NaN/Inf are already NULL in the frame)
    counts = {f"{kind}_{c}": (agg, "sum") for c in doubles for kind, agg in
              (("m", F.count_if(F.col(c).isNull())), ("n", F.count(c)))}
    middle = quantile_ranks([0.5])
    values, row, _ = order_statistics(frame, {c: F.col(c) for c in doubles},
                                      lambda c, n, seen: middle(c, n, seen) if seen[f"m_{c}"] else [], first=counts)
    out = {}
    for c in doubles:
        if row[f"m_{c}"]:
            median = interpolate(values[c], row[f"n_{c}"], [0.5])[0]
            out[c] = 0.0 if median is None else float(median)
    return out


def apply_fill(frame: DataFrame, fills: dict[str, float]) -> DataFrame:
    return frame.select(*[
        F.coalesce(F.col(c), F.lit(fills[c])).alias(c) if c in fills else F.col(c)
        for c in frame.columns])


def generate_features(raw: DataFrame, as_of, key: str = "username") -> DataFrame:
    """Raw users → key, ten finite features in contract order, churn (if labelled).

    The pre-fill frame is written as a table in the shared checkpoint folder because the fill values need a few passes over it: the written data
    is per user (a dozen columns), the source joins run once, and a lost
    executor re-reads the files instead of recomputing the joins.
    """
    frame = materialize(raw_feature_frame(raw, as_of, key), "features-prefill")
    fills = fill_values(frame)
    return apply_fill(frame, fills)


def split_xy(features: DataFrame):
    """(X columns, label column name or None): the reference's (X, y) pair as names."""
    cols = [c for c in FEATURE_COLUMNS if c in features.columns]
    return cols, ("churn" if "churn" in features.columns else None)

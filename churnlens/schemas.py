"""Schemas and the column-order contract shared by every module."""

from pyspark.sql import types as T

# The ten feature names in contract order.
FEATURE_COLUMNS = [
    "follower_ratio",
    "engagement_ratio",
    "days_since_last_activity",
    "account_age_days",
    "activity_frequency",
    "repos_per_year",
    "social_volume",
    "profile_completeness",
    "has_no_repos",
    "has_complete_profile",
]

# Default model inputs (the three features of the shipped model).
FINAL_FEATURES = [
    "days_since_last_activity",
    "activity_frequency",
    "repos_per_year",
]

# Columns the feature build cannot do without.
REQUIRED_RAW = ["created_at", "updated_at", "public_repos", "followers", "following"]

# The field names of the profile, repository and raw-user tables.
PROFILE = T.StructType([
    T.StructField("login", T.StringType(), False),
    T.StructField("type", T.StringType()),
    T.StructField("public_repos", T.LongType()),
    T.StructField("public_gists", T.LongType()),
    T.StructField("followers", T.LongType()),
    T.StructField("following", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("bio", T.StringType()),
    T.StructField("blog", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("hireable", T.BooleanType()),
])

REPO = T.StructType([
    T.StructField("owner", T.StringType(), False),
    T.StructField("pushed_at", T.StringType()),
    T.StructField("language", T.StringType()),
])

RAW_USERS = T.StructType([
    T.StructField("username", T.StringType(), False),
    T.StructField("public_repos", T.LongType()),
    T.StructField("public_gists", T.LongType()),
    T.StructField("followers", T.LongType()),
    T.StructField("following", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("bio", T.StringType()),
    T.StructField("blog", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("hireable", T.BooleanType()),
    T.StructField("days_since_update", T.LongType()),
    T.StructField("days_since_last_push", T.LongType()),
    T.StructField("churn", T.IntegerType()),
])

# Scoring request (one row = one request) and recommendation request.
SCORE_REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("days_since_last_activity", T.DoubleType()),
    T.StructField("activity_frequency", T.DoubleType()),
    T.StructField("repos_per_year", T.DoubleType()),
])

RECOMMEND_REQUEST = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("top_n", T.IntegerType()),
])


def require_columns(df, required, what="input"):
    """Raise naming every missing column (the reference's contract check)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}; "
                         f"available: {list(df.columns)}")

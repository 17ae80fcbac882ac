"""Request validation and scoring of request rows (FIL6, FIL7, FIL8, SCO1).

A request is a row; validation is a column expression that names the first
failing rule, so valid and rejected requests are two filters of one frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.schemas import FINAL_FEATURES

TOP_N_DEFAULT = 5
TOP_N_MAX = 10


def _first_error(checks) -> F.Column:
    out = F.lit(None).cast("string")
    for cond, msg in reversed(checks):
        out = F.when(cond, F.lit(msg)).otherwise(out)
    return out


def validate_score_requests(req: DataFrame, fields=FINAL_FEATURES) -> DataFrame:
    """Adds ``valid`` and ``error``: every field present, a number, finite and ≥ 0."""
    checks = []
    for c in fields:
        checks.append((F.col(c).isNull(), f"{c} is required"))
        checks.append((F.isnan(c) | (F.abs(c) == F.lit(float("inf"))) | (F.col(c) < 0), f"{c} must be >= 0"))
    err = _first_error(checks)
    return req.withColumn("error", err).withColumn("valid", F.col("error").isNull()) \
        .select(*req.columns, "valid", "error")


def validate_recommend_requests(req: DataFrame, users: DataFrame) -> DataFrame:
    """user_id ≥ 0, 1 ≤ top_n ≤ 10 (default 5), and the user must exist.

    ``users`` holds (user_id, username); the existence check is a left join on
    the index, so the result carries the username of every found user.
    """
    r = req.withColumn("top_n", F.coalesce(F.col("top_n"), F.lit(TOP_N_DEFAULT)))
    # a null or negative id matches no user, so those rows never enter the join
    known = F.col("user_id") >= 0
    j = (r.where(known).join(users.select("user_id", "username"), "user_id", "left")
         .unionByName(r.where(~F.coalesce(known, F.lit(False))).withColumn("username", F.lit(None).cast("string"))))
    err = _first_error([
        (F.col("user_id").isNull(), "user_id is required"),
        (F.col("user_id") < 0, "user_id must be >= 0"),
        ((F.col("top_n") < 1) | (F.col("top_n") > TOP_N_MAX), f"top_n must be between 1 and {TOP_N_MAX}"),
        (F.col("username").isNull(), "user_id not found"),
    ])
    return j.withColumn("error", err).withColumn("valid", F.col("error").isNull())


def answer_recommend_requests(checked: DataFrame, per_user: DataFrame) -> DataFrame:
    """One response per request: the user's top-``top_n`` advice when valid, else the error.

    ``per_user`` is the recommendation table computed once per user with the
    largest allowed ``top_n``; each request slices its own prefix.
    """
    answers = per_user.select("username", "churn_probability", "at_risk", "recommendations")
    asked = [c for c in checked.columns if c not in ("valid", "error")]
    # only valid requests meet the answers; rejected ones (all without an answer) stay out of the join
    good = checked.where("valid").join(answers, "username", "left").select(
        *asked, "valid", "error", "churn_probability", "at_risk",
        F.slice("recommendations", 1, F.col("top_n")).alias("recommendations"))
    none = [F.lit(None).cast(answers.schema[c].dataType).alias(c) for c in ("churn_probability", "at_risk", "recommendations")]
    return good.unionByName(checked.where("not valid").select(*asked, "valid", "error", *none))

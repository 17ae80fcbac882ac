"""Edge cases of flattening, labelling and the ten features (FIXTURES §2)."""

import math

import pytest
from pyspark.sql import functions as F

from churnlens.operators import labels as L
from churnlens.operators.features import generate_features, raw_feature_frame
from churnlens.schemas import FEATURE_COLUMNS
from conftest import AS_OF


def _by_user(df):
    return {r["username"]: r.asDict() for r in df.collect()}


def test_threshold_boundaries(profiles, repos):
    p = profiles([{"login": "at"}, {"login": "past"}, {"login": "part"}])
    r = repos([{"owner": "at", "pushed_at": "2023-01-01T00:00:00Z"},        # exactly 365 days
               {"owner": "past", "pushed_at": "2022-12-31T00:00:00Z"},      # 366 days
               {"owner": "part", "pushed_at": "2022-12-31T01:00:00Z"}])     # 365 d 23 h → 365
    out = _by_user(L.raw_users(p, r, AS_OF))
    assert out["at"]["days_since_last_push"] == 365 and out["at"]["churn"] == 0
    assert out["past"]["days_since_last_push"] == 366 and out["past"]["churn"] == 1
    assert out["part"]["days_since_last_push"] == 365 and out["part"]["churn"] == 0


def test_fallback_and_no_dates(profiles):
    p = profiles([{"login": "fb", "updated_at": "2022-11-27T00:00:00Z"},   # 400 days, no push
                  {"login": "none", "updated_at": None, "created_at": None}])
    out = _by_user(L.raw_users(p, None, AS_OF))
    assert out["fb"]["days_since_last_push"] is None and out["fb"]["days_since_update"] == 400
    assert out["fb"]["churn"] == 1
    assert out["none"]["churn"] == 0


def test_future_instant_and_junk_dates(profiles):
    p = profiles([{"login": "fut", "updated_at": "2024-01-01T02:00:00Z"},
                  {"login": "junk", "updated_at": "not-a-date"},
                  {"login": "empty", "updated_at": ""}])
    out = _by_user(L.raw_users(p, None, AS_OF))
    assert out["fut"]["days_since_update"] == -1
    assert out["junk"]["days_since_update"] is None
    assert out["empty"]["days_since_update"] is None


def test_organisations_dropped(profiles):
    p = profiles([{"login": "u"}, {"login": "o", "type": "Organization"}, {"login": "n", "type": None}])
    assert [r["username"] for r in L.raw_users(p, None, AS_OF).collect()] == ["u"]


def test_latest_valid_repo_date(profiles, repos):
    p = profiles([{"login": "u"}])
    r = repos([{"owner": "u", "pushed_at": None}, {"owner": "u", "pushed_at": "junk"},
               {"owner": "u", "pushed_at": "2023-06-01T00:00:00Z"}, {"owner": "u", "pushed_at": "2023-12-01T00:00:00Z"}])
    out = _by_user(L.raw_users(p, r, AS_OF))
    assert out["u"]["days_since_last_push"] == 31


def _features(profiles, rows):
    raw = L.raw_users(profiles(rows), None, AS_OF)
    return _by_user(generate_features(raw, AS_OF))


def test_new_account_rate(profiles):
    out = _features(profiles, [{"login": "new", "created_at": "2024-01-01T00:00:00Z", "public_repos": 3}])
    assert out["new"]["activity_frequency"] == pytest.approx(1095.75)
    assert out["new"]["repos_per_year"] == pytest.approx(1095.75)
    assert out["new"]["account_age_days"] == 0.0


def test_null_and_negative_counts(profiles):
    out = _features(profiles, [
        {"login": "nul", "public_repos": None, "followers": None, "following": None, "public_gists": None},
        {"login": "neg", "followers": -5, "following": 0}])
    assert out["nul"]["has_no_repos"] == 1
    assert out["nul"]["follower_ratio"] == 0.0 and out["nul"]["social_volume"] == 0.0
    assert out["neg"]["follower_ratio"] == 0.0


def test_profile_text_rules(profiles):
    out = _features(profiles, [
        {"login": "blank", "bio": "\t "},
        {"login": "none_lit", "bio": "None"},
        {"login": "none_pad", "bio": " None "},
        {"login": "hire_false", "hireable": False},
        {"login": "full", "bio": "b", "blog": "x.io", "company": "c", "hireable": True, "email": None}])
    assert out["blank"]["profile_completeness"] == 0.0
    assert out["none_lit"]["profile_completeness"] == 0.0
    assert out["none_pad"]["profile_completeness"] == 1.0
    assert out["hire_false"]["profile_completeness"] == 1.0
    assert out["full"]["profile_completeness"] == 4.0 and out["full"]["has_complete_profile"] == 1


def test_median_fill_and_all_missing(profiles):
    out = _features(profiles, [
        {"login": "a", "created_at": None, "updated_at": "2023-12-01T00:00:00Z"},
        {"login": "b", "created_at": None, "updated_at": "2023-12-03T00:00:00Z"},
        {"login": "c", "created_at": None, "updated_at": None}])
    # every created_at missing → F4, F5, F6 are 0.0
    for u in "abc":
        assert out[u]["account_age_days"] == 0.0
        assert out[u]["activity_frequency"] == 0.0 and out[u]["repos_per_year"] == 0.0
    # updated_at median of 31 and 29 days → 30
    assert out["c"]["days_since_last_activity"] == 30.0


def test_features_finite_and_ordered(profiles):
    out = L.raw_users(profiles([{"login": f"u{i}", "followers": i, "following": 2 * i} for i in range(20)]),
                      None, AS_OF)
    fx = generate_features(out, AS_OF)
    assert fx.columns == ["username", *FEATURE_COLUMNS, "churn"]
    for r in fx.collect():
        for c in FEATURE_COLUMNS:
            assert r[c] is not None and math.isfinite(r[c])


def test_missing_required_column(profiles):
    raw = L.raw_users(profiles([{"login": "x"}]), None, AS_OF).drop("followers")
    with pytest.raises(ValueError, match="followers"):
        raw_feature_frame(raw, AS_OF)


def test_no_gists_column(profiles):
    raw = L.raw_users(profiles([{"login": "x", "followers": 1, "following": 1}]), None, AS_OF).drop("public_gists")
    out = _by_user(generate_features(raw, AS_OF))
    assert out["x"]["social_volume"] == pytest.approx(math.log(3))


def test_repartition_invariance(profiles):
    raw = L.raw_users(profiles([{"login": f"u{i}", "followers": i % 7, "public_repos": i % 3,
                                 "created_at": None if i % 4 == 0 else "2019-01-01T00:00:00Z"} for i in range(40)]),
                      None, AS_OF)
    a = sorted(generate_features(raw, AS_OF).collect())
    b = sorted(generate_features(raw.repartition(7), AS_OF).collect())
    assert a == b


def test_label_monotone_in_threshold(profiles):
    raw = L.parse_users(profiles([{"login": f"u{i}", "updated_at": f"20{10 + i % 13}-06-01T00:00:00Z"}
                                  for i in range(30)]), None, AS_OF)
    shares = [L.churn_ratio_value(L.assign_labels(raw, t)) for t in (90, 180, 365, 730, 2000)]
    assert shares == sorted(shares, reverse=True)


def test_dates_must_come_first(spark):
    from churnlens.functions.scalars import parse_ts
    rows = ["2020-01-02T03:04:05Z", "2020-01-02 03:04:05", "2020-01-02", "12:30", "T12:30:00", "2020", "2020-1-1", "junk", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = [r["ok"] for r in df.select(parse_ts("s").isNotNull().alias("ok")).collect()]
    assert got == [True] * 3 + [False] * 7


def test_nan_and_infinite_requests_are_rejected(spark):
    from churnlens.operators.scoring import validate_score_requests
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (-1.0,), (None,)], "x double")
    assert [r["valid"] for r in validate_score_requests(df, ["x"]).collect()] == [True] + [False] * 4

"""Property tests over random profile sets (few examples: each one runs Spark jobs)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlens.operators import labels as L
from churnlens.operators.features import generate_features
from churnlens.schemas import FEATURE_COLUMNS
from conftest import AS_OF, profile_row
from churnlens.schemas import PROFILE

dates = st.one_of(st.none(), st.sampled_from(["", "junk", "2024-01-01T02:00:00Z"]),
                  st.dates(min_value=__import__("datetime").date(2005, 1, 1),
                           max_value=__import__("datetime").date(2023, 12, 31)).map(lambda d: f"{d}T00:00:00Z"))
counts = st.one_of(st.none(), st.integers(min_value=-3, max_value=10_000))
texts = st.one_of(st.none(), st.sampled_from(["", "  ", "\t", "None", " None ", "x", "hello world"]))
profile = st.fixed_dictionaries({
    "public_repos": counts, "public_gists": counts, "followers": counts, "following": counts,
    "created_at": dates, "updated_at": dates, "bio": texts, "blog": texts, "company": texts,
    "hireable": st.one_of(st.none(), st.booleans())})


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(profile, min_size=1, max_size=12))
def test_features_total_and_bounded(spark, rows):
    df = spark.createDataFrame([profile_row(f"u{i}", **r) for i, r in enumerate(rows)], PROFILE)
    raw = L.raw_users(df, None, AS_OF)
    out = generate_features(raw, AS_OF).collect()
    assert len(out) == len(rows)
    for r in out:
        for c in FEATURE_COLUMNS:
            assert r[c] is not None and math.isfinite(r[c])
        assert 0 <= r["profile_completeness"] <= 4
        assert r["has_complete_profile"] == int(r["profile_completeness"] == 4)
    shares = [L.churn_ratio_value(L.assign_labels(raw.drop("churn"), t)) for t in (30, 365, 3000)]
    assert shares[0] >= shares[1] >= shares[2]

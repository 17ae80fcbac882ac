"""Collection, cohorts and the three balance passes."""

from pyspark.sql import functions as F

from churnlens.operators import ingest as I
from churnlens.operators import labels as L
from conftest import AS_OF


def test_user_in_two_cohorts_once(profiles, repos):
    p = profiles([{"login": "both", "followers": 5, "public_repos": 2, "created_at": "1994-01-01T00:00:00Z"}])
    r = repos([{"owner": "both", "pushed_at": "2023-01-01T00:00:00Z", "language": "1-URGENT"}])
    cohorts = [I.Cohort(followers=(1, 100), language="1-URGENT"), I.Cohort(created_before="1995-06-01", repos=(1, 8))]
    assert I.candidate_users(p, r, cohorts).count() == 1


def test_cap_counts_users_only(profiles, repos):
    p = profiles([{"login": f"u{i}", "followers": 3, "type": "Organization" if i % 2 else "User"} for i in range(10)])
    df = I.collect_dataset(p, None, AS_OF, [I.Cohort(followers=(0, 10))], target_records=3, fetch_repos=False)
    assert sorted(r["username"] for r in df.collect()) == ["u0", "u2", "u4"]


def _labelled(profiles, n_old, n_new):
    rows = [{"login": f"o{i}", "updated_at": "2020-01-01T00:00:00Z"} for i in range(n_old)]
    rows += [{"login": f"n{i}", "updated_at": "2023-12-01T00:00:00Z"} for i in range(n_new)]
    return L.raw_users(profiles(rows), None, AS_OF)


def test_ratio_equal_to_minimum_accepted(profiles):
    df = _labelled(profiles, 1, 9)
    res = I.fix_low_churn_ratio(df, df.sparkSession.createDataFrame([], df.schema), AS_OF, 365, 0.10)
    assert res.passes == 0 and abs(res.ratio - 0.10) < 1e-12 and res.threshold == 365


def test_pass1_relabels(profiles):
    rows = [{"login": f"m{i}", "updated_at": "2023-01-01T00:00:00Z"} for i in range(5)]   # 365 days
    rows += [{"login": f"n{i}", "updated_at": "2023-12-01T00:00:00Z"} for i in range(5)]
    df = L.raw_users(profiles(rows), None, AS_OF)
    res = I.fix_low_churn_ratio(df, profiles([{"login": "zz"}]), AS_OF, 365, 0.4)
    assert res.passes == 1 and res.threshold == 275 and res.ratio == 0.5


def test_low_threshold_skips_pass1_and_stops_early(profiles):
    # threshold 170 → 80 < 90: pass 1 skipped, pass 2 labels at 170
    df = _labelled(profiles, 0, 10)
    pool = profiles(
        [{"login": f"a{i:03d}", "followers": 0, "public_repos": 1, "created_at": "1990-01-01T00:00:00Z",
          "updated_at": "2019-01-01T00:00:00Z"} for i in range(150)]
        + [{"login": f"b{i:03d}", "followers": 4, "public_repos": 1, "created_at": "1990-01-01T00:00:00Z",
            "updated_at": "2019-01-01T00:00:00Z"} for i in range(150)])
    cohorts = [I.Cohort(followers=(0, 3), repos=(1, 3), created_before="1995-06-01"),
               I.Cohort(followers=(0, 5), repos=(0, 2), created_before="1995-03-01")]
    res = I.fix_low_churn_ratio(df, pool, AS_OF, 170, 0.5, cohorts)
    assert res.passes == 2 and res.threshold == 170
    out = res.df
    # batch 1 alone (150 stale users + 10 fresh) already reaches the target → batch 2 dropped
    assert out.count() == 160 == out.select("username").distinct().count()
    assert out.where(F.col("username").startswith("a")).count() == 150
    # a caller may ask for a cut
    assert I.fix_low_churn_ratio(df, pool, AS_OF, 170, 0.5, cohorts, batch_cap=100).df.count() == 110


def test_recent_repos_per_owner(repos):
    r = repos([{"owner": "u", "pushed_at": f"2023-01-{d:02d}T00:00:00Z", "language": "x"} for d in range(1, 29)]
              + [{"owner": "u", "pushed_at": None, "language": "y"}, {"owner": "v", "pushed_at": "2020-01-01T00:00:00Z"}])
    out = I.recent_repos(r, 3).collect()
    u = sorted((x["recency_rank"], x["pushed_at"]) for x in out if x["owner"] == "u")
    assert u == [(1, "2023-01-28T00:00:00Z"), (2, "2023-01-27T00:00:00Z"), (3, "2023-01-26T00:00:00Z")]
    assert [x["recency_rank"] for x in out if x["owner"] == "v"] == [1]


def test_flags_equal_union_of_cohorts(profiles, repos):
    rows = [{"login": f"u{i:02d}", "followers": (i * 7) % 13 if i % 4 else None, "public_repos": i % 9,
             "created_at": f"19{90 + i % 9}-0{1 + i % 9}-01T00:00:00Z", "type": "User" if i % 6 else "Organization"}
            for i in range(40)]
    p = profiles(rows)
    r = repos([{"owner": f"u{i:02d}", "pushed_at": "2000-01-01T00:00:00Z", "language": ["1-URGENT", "2-HIGH", "x"][i % 3]}
               for i in range(0, 40, 2)])
    flags = sorted(x["username"] for x in I.candidate_users(p, r).collect())
    union = set()
    for c in I.DEFAULT_COHORTS:
        union |= {x["login"] for x in I.cohort_members(p, r, c).collect()}
    assert flags == sorted(union) and len(flags) > 0


def test_label_sources(profiles, repos):
    p = profiles([{"login": "a"}, {"login": "b"}, {"login": "c", "updated_at": None}])
    r = repos([{"owner": "a", "pushed_at": "2020-01-01T00:00:00Z"}])
    got = {x["label_source"]: (x["n"], x["churned"]) for x in L.label_sources(L.raw_users(p, r, AS_OF)).collect()}
    assert got == {"push": (1, 1), "update": (1, 0), "none": (1, 0)}


def test_no_inactivity_cohorts(profiles):
    res = I.fix_low_churn_ratio(_labelled(profiles, 0, 10), profiles([{"login": "zz"}]), AS_OF, 170, 0.5, [])
    assert (res.passes, res.ratio, res.df.count()) == (2, 0.0, 10)


def test_caps_take_each_cohort_in_turn(profiles):
    # x matches both cohorts; the first takes a, b and leaves x to the second
    pool = profiles([{"login": n, "followers": f, "public_repos": 1, "created_at": "1990-01-01T00:00:00Z",
                      "updated_at": "2023-12-31T00:00:00Z"} for n, f in (("a", 0), ("b", 0), ("x", 0), ("y", 4), ("z", 4))])
    cohorts = [I.Cohort(followers=(0, 3)), I.Cohort(followers=(0, 5))]
    res = I.fix_low_churn_ratio(_labelled(profiles, 0, 3), pool, AS_OF, 170, 0.9, cohorts, batch_cap=2)
    assert sorted(r["username"] for r in res.df.collect() if len(r["username"]) == 1) == ["a", "b", "x", "y"]

"""Filters, split, folds, weights and scalers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import sampling as S
from churnlens.operators import selection as SEL


@pytest.fixture
def small(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(200):
        y = int(i % 5 == 0)
        x = float(rng.normal() + 2 * y)
        rows.append((f"u{i:03d}", y, x, x, 1.0, float(rng.normal()), float(rng.normal()) * 0.01))
    return spark.createDataFrame(rows, "username string, churn int, f1 double, f2 double, const double, "
                                       "noise double, tiny double")


COLS = ["f1", "f2", "const", "noise", "tiny"]


def test_variance_and_identical_pair(small):
    t = {r["feature"]: r for r in SEL.filter_method(small, COLS, top_k=2).collect()}
    assert not t["const"]["variance_kept"] and not t["tiny"]["variance_kept"]
    # identical pair: equal F, the later one is dropped
    assert t["f1"]["corr_kept"] and not t["f2"]["corr_kept"]
    assert t["f1"]["anova_rank"] == 1 and t["f2"]["anova_rank"] == 2
    assert t["const"]["f_score"] is None and t["const"]["anova_rank"] == 5
    assert t["f1"]["filter_final"] and not t["f2"]["filter_final"]


def test_anova_matches_closed_form(small):
    pdf = small.toPandas()
    g = [pdf[pdf.churn == k].noise.values for k in (0, 1)]
    allv = pdf.noise.values
    ssb = sum(len(x) * (x.mean() - allv.mean()) ** 2 for x in g)
    ssw = sum(((x - x.mean()) ** 2).sum() for x in g)
    f = ssb / (ssw / (len(allv) - 2))
    got = {r["feature"]: r["f_score"] for r in SEL.anova_scores(small, COLS).collect()}["noise"]
    assert got == pytest.approx(f)


def test_split_quotas_and_determinism(small):
    s1 = S.stratified_split(small)
    c = {(r["churn"], r["is_test"]): r["count"] for r in s1.groupBy("churn", "is_test").count().collect()}
    assert c[(1, True)] == 8 and c[(0, True)] == 32          # 40 test rows = ceil(0.2·200), stratified
    s2 = S.stratified_split(small.repartition(5))
    assert sorted(s1.where("is_test").select("username").collect()) == \
        sorted(s2.where("is_test").select("username").collect())


def test_quota_rule():
    assert S.class_quotas({0: 700, 1: 492}) == {0: 140, 1: 99}
    assert sum(S.class_quotas({0: 7, 1: 3}).values()) == 2


def test_folds_and_weights(small):
    f = S.kfold_assignment(small)
    sizes = {(r["churn"], r["fold"]): r["count"] for r in f.groupBy("churn", "fold").count().collect()}
    assert all(sizes[(1, k)] == 8 and sizes[(0, k)] == 32 for k in range(5))
    w = {r["churn"]: r["weight"] for r in S.class_weights(small).collect()}
    assert w[1] == pytest.approx(200 / (2 * 40)) and w[0] == pytest.approx(200 / (2 * 160))


def test_scalers(small):
    st = S.fit_standard(small, ["noise", "const"])
    z = S.apply_standard(small, st).toPandas()
    assert z.noise.mean() == pytest.approx(0, abs=1e-12) and z.noise.std(ddof=0) == pytest.approx(1)
    assert (z.const == 0).all()
    mm = S.apply_minmax(small, S.fit_minmax(small, ["noise", "const"])).toPandas()
    assert mm.noise.min() == 0 and mm.noise.max() == 1 and (mm.const == 0).all()


def test_repeated_key_stays_on_one_side(spark):
    df = spark.createDataFrame([("same", i % 2) for i in range(50)], "username string, churn int")
    assert S.stratified_split(df).select("is_test").distinct().count() == 1
    assert S.kfold_assignment(df).select("fold").distinct().count() == 1


def test_rare_class_is_spread_over_the_folds(spark):
    df = spark.createDataFrame([(f"u{i:04d}", int(i % 143 == 0)) for i in range(1000)], "username string, churn int")
    f = S.kfold_assignment(df)
    sizes = {(r["churn"], r["fold"]): r["count"] for r in f.groupBy("churn", "fold").count().collect()}
    for c in (0, 1):
        each = [sizes.get((c, k), 0) for k in range(5)]
        assert max(each) - min(each) <= 1
    assert sum(sizes[(1, k)] for k in range(5)) == 7
    few = S.kfold_assignment(df.where("churn = 1").limit(3))
    assert sorted(r["count"] for r in few.groupBy("fold").count().collect()) == [1, 1, 1]


def test_equal_first_hash_words_are_cut_by_the_second(spark, monkeypatch):
    real = S.hash_key
    monkeypatch.setattr(S, "hash_key", lambda key="username", seed=42, word=0: F.lit(7).cast("long") if not word else real(key, seed, 1))
    df = spark.createDataFrame([(f"u{i}", i % 2) for i in range(100)], "username string, churn int")
    assert S.stratified_split(df).where("is_test").count() == 20
    assert {r["count"] for r in S.kfold_assignment(df).groupBy("churn", "fold").count().collect()} == {10}


def test_describe_skips_nan(spark):
    from churnlens.operators.profile import describe
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    r = describe(df, ["x"]).first()
    assert r["count"] == 2 and r["mean"] == 2.0 and r["p50"] == 2.0 and r["max"] == 3.0

"""PCA / SVD against numpy; recommendation gating and ordering; JVM-side index."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import latent as LT

COLS = ["a", "b", "c", "d"]


@pytest.fixture
def mat(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 4))
    rows = [(f"u{i:03d}", i % 2, *map(float, x[i])) for i in range(120)]
    return x, spark.createDataFrame(rows, "username string, churn int, a double, b double, c double, d double")


def test_svd_reconstruction_matches_numpy(mat):
    x, df = mat
    fit = LT.fit_svd(df, COLS, k=2)
    xs = (x - x.min(0)) / (x.max(0) - x.min(0))
    u, s, vt = np.linalg.svd(xs, full_matrices=False)
    rec = (u[:, :2] * s[:2]) @ vt[:2]
    got = {r["username"]: r for r in LT.svd_reconstruct(df, fit).collect()}
    for i in range(120):
        assert np.allclose(got[f"u{i:03d}"]["reconstructed"], rec[i], atol=1e-8)
    assert np.allclose(fit.sigma, s[:2])


def test_pca_ratios_match_numpy(mat):
    x, df = mat
    fit = LT.fit_pca(df, COLS)
    z = (x - x.mean(0)) / x.std(0)
    ev = np.sort(np.linalg.eigvalsh(np.cov(z.T, bias=True)))[::-1]
    assert np.allclose(fit.ratios, ev / ev.sum())
    assert fit.ratios.sum() == pytest.approx(1.0)
    proj = LT.pca_project(df, fit, 2).toPandas()
    assert proj.pc1.var() >= proj.pc2.var()


def test_user_index_contiguous(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(257)], "username string").repartition(9)
    idx = sorted((r["user_id"], r["username"]) for r in LT.user_index(df).collect())
    assert idx == [(i, f"k{i:04d}") for i in range(257)]


def test_recommend_gate_and_ties(spark):
    users = spark.createDataFrame([("hi", 0), ("lo", 1), ("edge", 2)], "username string, user_id long")
    scores = spark.createDataFrame([("hi", 0.5), ("lo", 0.4999), ("edge", 0.9)], "username string, churn_probability double")
    latent = spark.createDataFrame(
        [("hi", [0.0, 0.0, 0.0], [0.3, 0.1, 0.3]), ("lo", [0.0, 0.0, 0.0], [1.0, 1.0, 1.0]),
         ("edge", [0.5, 0.5, 0.5], [0.4, 0.4, 0.4])],
        "username string, scaled array<double>, reconstructed array<double>")
    out = {r["username"]: r for r in LT.recommend(users, scores, latent, ["x", "y", "z"], 2).collect()}
    assert out["lo"]["at_risk"] is False and out["lo"]["recommendations"] == []
    hi = out["hi"]["recommendations"]
    assert out["hi"]["at_risk"] is True and [r["feature"] for r in hi] == ["z", "x"]   # tie → later first
    assert hi[0]["gap_score"] == 0.3
    # non-positive gaps are still listed (as in the reference) unless positive_only
    assert len(out["edge"]["recommendations"]) == 2
    only = LT.recommend(users, scores, latent, ["x", "y", "z"], 2, positive_only=True)
    assert only.where(F.col("username") == "edge").first()["recommendations"] == []


def test_small_singular_values_keep_their_digits(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(500, 2))
    x = np.column_stack([base[:, 0], base[:, 0] + 1e-10 * base[:, 1], base[:, 1]])  # nearly collinear
    df = spark.createDataFrame([(*map(float, r),) for r in x], "a double, b double, c double").repartition(7)
    r = LT.r_factor(df, ["a", "b", "c"])
    want = np.linalg.svd(x, compute_uv=False)
    assert np.allclose(np.linalg.svd(r, compute_uv=False), want, rtol=1e-5)  # the Gram matrix loses the last one
    assert abs(np.sqrt(abs(np.linalg.eigvalsh(x.T @ x)[0])) / want[-1] - 1) > 1e-3
    assert np.allclose(LT.r_factor(df.limit(0), ["a", "b"]), 0) and LT.r_factor(df.limit(1), ["a", "b", "c"]).shape == (3, 3)


def test_loadings_are_orthogonal_and_leave_the_least_rest(mat):
    x, df = mat
    fit = LT.fit_svd(df, COLS, k=2)
    xs = (x - x.min(0)) / (x.max(0) - x.min(0))
    assert np.allclose(fit.v.T @ fit.v, np.eye(2), atol=1e-12)
    rest = np.linalg.norm(xs - xs @ fit.v @ fit.v.T) ** 2
    assert rest == pytest.approx(fit.trace - (fit.sigma ** 2).sum(), abs=1e-9)
    p = LT.fit_pca(df, COLS)
    assert np.allclose(p.components.T @ p.components, np.eye(4), atol=1e-12)

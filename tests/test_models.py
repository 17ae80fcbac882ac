"""Model-based selection and scoring: invariants, tiers, metrics rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.functions.scalars import risk_level
from churnlens.operators import models as M
from churnlens.operators import profile as P
from churnlens.operators.scoring import validate_recommend_requests, validate_score_requests

COLS = ["a", "b", "c", "d", "e", "f", "g"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        y = int(rng.random() < 0.4)
        v = rng.normal(size=7)
        v[0] += 2.5 * y
        v[1] -= 1.5 * y
        rows.append((f"u{i:03d}", y, *map(float, v)))
    return spark.createDataFrame(rows, "username string, churn int, " + ", ".join(f"{c} double" for c in COLS))


def test_rfe_ranks(data):
    r = {x["feature"]: x["rfe_rank"] for x in M.rfe_ranking(data, COLS, 3).collect()}
    assert sorted(r.values()) == [1, 1, 1, 2, 3, 4, 5]
    assert r["a"] == 1 and r["b"] == 1


def test_importances(data):
    for t in (M.dt_importance(data, COLS), M.rf_importance(data, COLS, trees=20)):
        pdf = t.toPandas()
        imp = pdf.iloc[:, 2]
        assert (imp >= 0).all() and imp.sum() == pytest.approx(1.0)
        assert sorted(pdf.iloc[:, 3]) == list(range(1, 8))


def test_holdout_better_than_majority(data):
    res = M.train_and_save(data, ["a", "b"], trees=30)
    m = res["metrics"].first()
    assert 0 <= m["f1"] <= 1 and m["accuracy"] > 0.7
    rep = {r["class"]: r for r in res["report"].collect()}
    assert rep["accuracy"]["support"] == 60


def test_cv_metrics_in_range(data):
    m = M.cv_metrics(data, ["a", "b"], trees=10).first()
    for k in ("cv_accuracy", "cv_precision", "cv_recall", "cv_f1"):
        assert 0.0 <= m[k] <= 1.0


def test_save_load_score(data, tmp_path):
    res = M.train_and_save(data, ["a", "b"], trees=10, model_path=str(tmp_path / "model"))
    model = M.load_model(str(tmp_path / "model"))
    s = M.score_users(model, data.select("username", "a", "b")).collect()
    assert {r["risk_level"] for r in s} <= {"LOW", "MEDIUM", "HIGH", "CRITICAL"}
    with pytest.raises(FileNotFoundError):
        M.load_model(str(tmp_path / "missing"))


def test_risk_tiers(spark):
    df = spark.createDataFrame([(0.2999,), (0.30,), (0.60,), (0.80,)], "p double")
    assert [r[0] for r in df.select(risk_level("p")).collect()] == ["LOW", "MEDIUM", "HIGH", "CRITICAL"]


def test_no_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "churn int, prediction int")
    m = P.binary_metrics(df).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_request_validation(spark):
    req = spark.createDataFrame([("ok", 1.0, 0.0, 2.0), ("neg", -1.0, 0.0, 0.0), ("miss", 1.0, None, 1.0)],
                                "request_id string, days_since_last_activity double, activity_frequency double, "
                                "repos_per_year double")
    v = {r["request_id"]: r for r in validate_score_requests(req).collect()}
    assert v["ok"]["valid"] and not v["neg"]["valid"] and "activity_frequency" in v["miss"]["error"]
    users = spark.createDataFrame([(0, "a"), (1, "b")], "user_id long, username string")
    rr = spark.createDataFrame([(0, None), (5, 3), (1, 11), (-1, 2)], "user_id long, top_n int")
    out = {r["user_id"]: r for r in validate_recommend_requests(rr, users).collect()}
    assert out[0]["valid"] and out[0]["top_n"] == 5
    assert out[5]["error"] == "user_id not found"
    assert "top_n" in out[1]["error"] and "user_id" in out[-1]["error"]


def test_comparison_vote_rule(spark):
    filt = spark.createDataFrame([("x", 0, 1, True), ("y", 1, 2, True), ("z", 2, 3, False)],
                                 "feature string, ordinal int, anova_rank int, anova_top boolean")
    rfe = spark.createDataFrame([("x", True), ("y", False)], "feature string, rfe_selected boolean")
    dt = spark.createDataFrame([("x", 1), ("y", 9), ("z", 2)], "feature string, dt_rank int")
    rf = spark.createDataFrame([("x", 2), ("y", 1)], "feature string, rf_rank int")
    t = {r["feature"]: r for r in M.comparison_table(filt, rfe, dt, rf).collect()}
    assert (t["x"]["methods_agreeing"], t["x"]["decision"]) == (4, "Keep")
    assert (t["y"]["methods_agreeing"], t["y"]["decision"]) == (2, "Optional")
    assert (t["z"]["rf_rank"], t["z"]["decision"]) == (99, "Drop")


def test_newton_reaches_the_minimum(data):
    rows = M.with_label(data)
    x = np.array([[r[c] for c in COLS] for r in data.collect()])
    y = np.array([r["churn"] for r in data.collect()], float)
    w = M.logistic_newton(rows, COLS, "label")
    full = np.column_stack([np.ones(len(x)), x])

    def gradient(w):
        return full.T @ (1 / (1 + np.exp(-full @ w)) - y) + np.r_[0.0, w[1:]]
    assert np.abs(gradient(w)).max() < 1e-7
    # from a far start the halved steps arrive at the same place
    assert np.abs(M.logistic_newton(rows, COLS, "label", np.full(len(COLS) + 1, 25.0)) - w).max() < 1e-7
    # separable rows and a single class have a minimum too
    apart = rows.where("(a > 1 and churn = 1) or (a < 0 and churn = 0)")
    assert np.isfinite(M.logistic_newton(apart, ["a"], "label")).all()
    assert np.isfinite(M.logistic_newton(rows.where("churn = 1"), ["a"], "label")).all()


def _bins(binned):
    return [f"{c}__bin" for c in binned.cols]


def test_large_binned_tables_are_laid_out(data, monkeypatch):
    plain = M.Binned(data, COLS[:3], keep=["username"])
    monkeypatch.setattr(M, "LAID_ROWS", 100)
    laid = M.Binned(data, COLS[:3], keep=["username"])
    parts = [list(p) for p in laid.table.rdd.glom().collect() if p]
    assert len(parts) == 3 and all(90 <= len(p) <= 110 for p in parts)
    for p in parts:
        bins = [tuple(r[c] for c in _bins(laid)) for r in p]
        assert bins == sorted(bins)
    assert sorted(laid.table.collect()) == sorted(plain.table.collect())
    assert laid.counts and {r["churn"]: r["n"] for r in laid.counts} == {r["churn"]: r["n"] for r in plain.counts}


@pytest.mark.parametrize("rows,most", [(10 ** 9, 3), (600, 2), (300, 1), (10, 1)])
def test_forests_at_once_follow_the_rows(data, monkeypatch, rows, most):
    """All six fits share one pool, which is the smaller the more rows a fit holds."""
    import threading
    running, seen, lock, all_in = [0], [], threading.Lock(), threading.Barrier(most)

    def fit(self, *a):
        with lock:
            running[0] += 1
            seen.append(running[0])
        all_in.wait(60)  # six fits come in whole groups
        with lock:
            running[0] -= 1
        return "model"

    metrics = data.sparkSession.createDataFrame([(1.0, 1.0, 1.0, 1.0)], "accuracy double, precision double, recall double, f1 double")
    monkeypatch.setattr(M, "FITTED_ROWS", rows)
    monkeypatch.setattr(M.Binned, "fit", fit)
    monkeypatch.setattr(M.Binned, "predict", lambda self, model, where: data)
    monkeypatch.setattr(M.P, "binary_metrics", lambda *a: metrics)
    monkeypatch.setattr(M.P, "classification_report", lambda *a: metrics)
    res = M.train_and_save(data, COLS[:2], cv=True)
    assert res["model"] == "model" and len(seen) == 6 and max(seen) == most
    assert tuple(res["cv_metrics"].first()) == (1.0, 1.0, 1.0, 1.0)

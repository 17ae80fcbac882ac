"""Continuous scoring over a file source with an availableNow trigger."""

from churnlens.operators import models as M
from churnlens.streaming.scoring import start_scoring_stream


def test_stream_scores_and_rejects(spark, tmp_path):
    rows = [(f"u{i}", float(i % 40) * 20, float(i % 7), float(i % 7), int(i % 40 > 18)) for i in range(120)]
    df = spark.createDataFrame(rows, "username string, days_since_last_activity double, activity_frequency double, "
                                     "repos_per_year double, churn int")
    model = M.train_and_save(df, trees=10)["model"]
    src = tmp_path / "req"
    req = spark.createDataFrame([("a", 800.0, 1.0, 1.0), ("b", 5.0, 3.0, 3.0), ("c", -1.0, 1.0, 1.0),
                                 ("d", float("nan"), 1.0, 1.0), ("e", 1.0, float("inf"), 1.0)],
                                "request_id string, days_since_last_activity double, activity_frequency double, "
                                "repos_per_year double")
    req.write.json(str(src))
    sink, ck = tmp_path / "out", tmp_path / "ck"
    start_scoring_stream(spark, model, str(src), str(sink), str(ck))
    scored = {r["request_id"]: r for r in spark.read.parquet(str(sink / "scored")).collect()}
    rejected = {r["request_id"]: r for r in spark.read.parquet(str(sink / "rejected")).collect()}
    assert set(scored) == {"a", "b"} and set(rejected) == {"c", "d", "e"}
    assert scored["a"]["churn_probability"] >= scored["b"]["churn_probability"]
    # a restart with the same checkpoint re-processes nothing
    start_scoring_stream(spark, model, str(src), str(sink), str(ck))
    assert spark.read.parquet(str(sink / "scored")).count() == 2


def _model(spark):
    rows = [(f"u{i}", float(i % 40) * 20, float(i % 7), float(i % 7), int(i % 40 > 18)) for i in range(120)]
    df = spark.createDataFrame(rows, "username string, days_since_last_activity double, activity_frequency double, "
                                     "repos_per_year double, churn int")
    return M.train_and_save(df, trees=5)["model"]


def test_broken_lines_are_rejected_and_a_backlog_comes_in_batches(spark, tmp_path):
    src = tmp_path / "req"
    src.mkdir()
    good = '{"request_id": "r%d", "days_since_last_activity": 5, "activity_frequency": 1, "repos_per_year": 1}'
    for i in range(6):
        lines = [good % i, "{broken", '{"request_id": "t%d", "days_since_last_activity": "many", "activity_frequency": 1, "repos_per_year": 1}' % i]
        (src / f"f{i}.json").write_text("\n".join(lines))
    sink = tmp_path / "out"
    start_scoring_stream(spark, _model(spark), str(src), str(sink), str(tmp_path / "ck"), max_files=2)
    scored = spark.read.parquet(str(sink / "scored")).collect()
    rejected = spark.read.parquet(str(sink / "rejected")).collect()
    assert sorted(r["request_id"] for r in scored) == [f"r{i}" for i in range(6)]
    assert len({r["batch_id"] for r in scored}) == 3
    assert len(rejected) == 12 and all(r["error"].startswith("not a JSON request: {") for r in rejected)
    assert sum("{broken" in r["error"] for r in rejected) == 6
